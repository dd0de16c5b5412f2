"""Medallion lakehouse building blocks on plain Spark."""
