"""Column builders. Everything here is a native Spark expression; there are no UDFs."""
