"""Column expressions: keys, money, dates and fixed look-ups."""
