"""Column expressions: parsing, calendar, labels and map styling."""
