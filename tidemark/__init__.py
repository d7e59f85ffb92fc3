"""Change data to star schema, as plain PySpark DataFrame code."""
