"""Readers: Parquet tables, CSV, JDBC, literal rows and the catalog."""
