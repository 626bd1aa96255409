"""Customer datamart operators for PySpark."""
