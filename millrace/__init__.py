"""millrace: event-stream analytics on Spark DataFrames, batch and streaming."""
