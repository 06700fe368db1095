"""Readers: topics, CSV files, stored tables."""
