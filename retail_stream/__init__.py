"""Real-time retail warehouse on Spark SQL and Structured Streaming."""
