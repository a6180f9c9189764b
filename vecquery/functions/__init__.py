"""Column expressions: keys, vectors and text."""
