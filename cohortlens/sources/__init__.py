"""Readers, writers and the shared-folder intermediate tables."""
