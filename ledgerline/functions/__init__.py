"""Column builders made of Spark built-ins only (no Python UDFs)."""
