"""Column expressions: built-in Spark functions only, no UDFs."""
