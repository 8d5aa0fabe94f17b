"""Column expressions: parsing, labels, trip measures, calendar parts, keys and exact rounding."""
