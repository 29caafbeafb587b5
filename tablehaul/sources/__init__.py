"""Readers: files (CSV/parquet), SQL sources (JDBC or Spark catalog), generator."""
