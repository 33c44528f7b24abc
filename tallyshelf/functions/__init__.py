"""Column expressions: numbers, dates, titles."""
