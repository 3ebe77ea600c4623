"""Column expressions: text, money, dates and business rules."""
