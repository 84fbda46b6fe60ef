"""Batch analytics over trip feeds, written against the Spark DataFrame API."""
