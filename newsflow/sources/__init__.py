"""Scans of landed files and stored tables (S-1..S-6)."""
