"""Column expressions: text, numbers and keys."""
