"""Readers, writers and the storage layout."""
