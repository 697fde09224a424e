"""Batch and streaming data-mart jobs written against the Spark DataFrame API."""
