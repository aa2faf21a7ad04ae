"""Structured Streaming wrappers (ST-1, ST-6, ST-8, A-3 state fold)."""
