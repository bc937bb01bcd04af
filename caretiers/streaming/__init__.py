"""Incremental ingestion of landing files into bronze tables."""
