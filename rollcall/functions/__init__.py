"""Column expressions built only from ``pyspark.sql.functions`` (JVM side)."""
