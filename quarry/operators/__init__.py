"""Profiling, gating, fingerprint, edge, mining and drift operators."""
