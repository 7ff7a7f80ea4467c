"""Readers and writers of the raw, trusted and result zones."""
