"""Event streams with evolving payload schemas, on Spark."""
