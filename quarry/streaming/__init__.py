"""Incremental profiles of streams."""
