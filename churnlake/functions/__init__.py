"""Column expressions: rounding, ladders, bands, text and risk scores."""
