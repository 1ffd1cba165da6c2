"""Structured Streaming forms of the operational metrics (L1-L4)."""
