"""Column-level helpers: all built-in Spark expressions, no Python UDFs."""
