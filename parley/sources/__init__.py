"""Readers and the table store."""
