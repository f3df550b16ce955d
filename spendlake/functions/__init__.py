"""Column expressions: times, amounts and JSON maps."""
