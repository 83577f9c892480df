"""Column expressions: text, numbers, Student's t."""
