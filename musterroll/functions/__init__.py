"""Column expressions: cleaning, periods, regions, text similarity."""
