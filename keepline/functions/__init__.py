"""Column expressions and ordered-aggregation helpers."""
