"""Structured Streaming forms of the change check and the change batches."""
