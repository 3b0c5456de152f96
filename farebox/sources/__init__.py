"""Descriptors, readers and managed tables."""
