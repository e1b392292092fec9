"""Decisions before a scan, query plans and document sinks."""
