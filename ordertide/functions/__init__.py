"""Column-level helpers. All are built-in Spark expressions, no Python UDFs."""
