"""Column functions: plain Spark expressions, no UDFs."""
