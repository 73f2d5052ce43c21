"""Continuous ingestion of landing event files."""
