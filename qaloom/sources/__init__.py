"""Readers, writers and location fallback."""
