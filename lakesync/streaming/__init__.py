"""Incremental landing: the batch operators driven by Structured Streaming."""
