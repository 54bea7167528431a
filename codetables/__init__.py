"""Spark jobs that build and maintain versioned tables of coded concepts."""
