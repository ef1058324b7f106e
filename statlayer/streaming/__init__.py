"""statlayer.streaming."""
