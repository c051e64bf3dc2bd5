"""Credit-risk mart analytics as Spark DataFrame, SQL and Structured Streaming jobs."""
