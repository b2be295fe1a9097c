"""Sinks: CSV, partitioned Parquet lake, JDBC, and versioned publication."""
