"""Earthquake impact scoring and relief logistics as Spark DataFrame jobs."""
