"""Versioned master data on Spark: audit, migrate, load and query change logs."""
