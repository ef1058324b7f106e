"""statlayer.publish."""
