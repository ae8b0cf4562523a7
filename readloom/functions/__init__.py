"""Column functions. Everything here is a composition of built-in Spark expressions."""
