"""Column expressions: cleaning of raw values and row-wise features."""
