"""Column functions: text, vectors and the fixed word lists."""
