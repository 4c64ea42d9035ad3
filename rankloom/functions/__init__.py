"""Column functions: text, scoring and rounding expressions built from Spark SQL functions."""
