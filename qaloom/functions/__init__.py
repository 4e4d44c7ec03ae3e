"""Column-level building blocks; every one is a plain Spark SQL expression."""
