"""Column expressions; all compile to built-in Spark functions."""
