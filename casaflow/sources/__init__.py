"""Sources: wide monthly CSV files, relational tables (Parquet / JDBC) and the
landing frames derived from the TPC-H-style test tables."""
