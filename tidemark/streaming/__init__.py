"""Structured Streaming: continuous queries, change-log subscription, ingest."""
