"""statlayer.sources."""
