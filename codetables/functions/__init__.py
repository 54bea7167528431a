"""Column expressions: codes, labels, dates, keys and row contents."""
