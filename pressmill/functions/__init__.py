"""Column expressions: text, labels, quality, numbers."""
