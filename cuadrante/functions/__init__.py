"""Column helpers.  Each returns a Column built from built-in Spark functions."""
