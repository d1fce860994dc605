"""Declared schemas, readers (Parquet, CSV, JDBC) and sinks."""
