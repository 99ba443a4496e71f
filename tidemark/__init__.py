"""Predictive analytics on tables, written as Spark DataFrame jobs."""
