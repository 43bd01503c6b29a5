"""Structured Streaming twins of the online operators (ST1-ST6)."""
