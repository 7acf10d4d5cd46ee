"""Compliance-audit analytics as Spark DataFrame jobs."""
