"""Readers of landed files and tables, fixed lookups and the trend table sink."""
