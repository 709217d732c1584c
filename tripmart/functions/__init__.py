"""Column expressions: trip measures, bands, exact decimals, period labels."""
