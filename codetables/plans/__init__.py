"""Whole jobs, from release files to a version."""
