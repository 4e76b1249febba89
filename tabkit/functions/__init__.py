"""Column expressions.  All are native Spark expressions; there is no UDF."""
