"""The same ingest and aggregations as Structured Streaming (rows T-1 to T-6)."""
