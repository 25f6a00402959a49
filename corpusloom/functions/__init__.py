"""Column -> Column building blocks; all of them are Spark SQL expressions."""
