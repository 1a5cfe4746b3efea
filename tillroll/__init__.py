"""Retail invoice-line analytics as plain Spark DataFrame work."""
