"""Column expressions. Every one is made of built-in Spark functions."""
