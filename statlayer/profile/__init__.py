"""statlayer.profile."""
