"""Retail star schema and data marts as PySpark DataFrame jobs."""
