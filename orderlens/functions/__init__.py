"""Column expressions and small aggregation helpers."""
