"""Readers and the year-partitioned store."""
