"""Structured Streaming loaders: available-now file ingestion and upserts."""
