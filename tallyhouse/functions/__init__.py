"""Column expressions; each compiles to built-in Spark functions."""
