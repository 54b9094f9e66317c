"""Customer analytics on Spark."""
