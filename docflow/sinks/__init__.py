"""Sinks: JDBC, JSON lines, versioned Parquet store, idempotent batch directories."""
