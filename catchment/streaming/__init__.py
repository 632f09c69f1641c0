"""Incremental (file-stream) ingestion."""
