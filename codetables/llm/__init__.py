"""Training-data operators: scoring, scanning, counting, deduplication and packing of text columns."""
