"""Column expressions: built-in Spark expressions throughout, no Python UDF."""
