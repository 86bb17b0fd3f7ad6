"""Structured Streaming runners, event-time aggregations and multi-hop pipelines."""
