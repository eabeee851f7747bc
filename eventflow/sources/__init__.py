"""Readers, path metadata and writers."""
