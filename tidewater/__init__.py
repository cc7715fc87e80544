"""Spark operators and ready-made analytics queries."""
