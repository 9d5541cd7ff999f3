"""Customer-retention analytics on PySpark."""
