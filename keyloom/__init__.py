"""Analysis, replication and verification of ordered key-value data, as Spark DataFrame operations."""
