"""Incremental table maintenance on Spark: conform, shape, upsert, diff, append."""
