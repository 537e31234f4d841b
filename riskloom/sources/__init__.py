"""Readers and writers: CSV files, messages, score tables."""
