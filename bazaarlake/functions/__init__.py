"""Column expressions: casts, text cleaning, calendar and file names."""
