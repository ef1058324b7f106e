"""statlayer.quality."""
