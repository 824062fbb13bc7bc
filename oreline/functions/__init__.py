"""Column expressions: text, dates, numbers, business rules."""
