"""trackline: cycle-aware machine sensor analytics on Spark."""
