"""Column expressions and statistics."""
