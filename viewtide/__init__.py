"""Clickstream star-schema analytics on Spark DataFrames and Structured Streaming."""
