"""Event streams: contracts, and ingest to bronze with Structured Streaming."""
