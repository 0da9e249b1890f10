"""Readers and table storage."""
