"""statlayer.plans."""
