"""Column helpers. Every function returns a Column built from Spark built-ins."""
