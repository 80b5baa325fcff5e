"""Column expressions: dates, arithmetic and text."""
