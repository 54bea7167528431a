"""Readers of release files and writers of versions."""
