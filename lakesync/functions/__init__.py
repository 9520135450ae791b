"""Column functions: everything stays a built-in Spark expression."""
