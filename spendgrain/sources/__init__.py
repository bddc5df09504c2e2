"""Readers and writers: CSV, Parquet, JSON, JDBC, and the adapter over the test tables."""
