"""Column expressions: every row-level transform is a built-in Spark expression."""
