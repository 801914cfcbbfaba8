"""Structured Streaming jobs; metric aggregations work on batch DataFrames as well."""
