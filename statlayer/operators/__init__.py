"""statlayer.operators."""
