"""ontime: on-time-performance analytics on Spark DataFrames, SQL and Structured Streaming."""

__version__ = "0.1.0"
