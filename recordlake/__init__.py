"""Typed records, graphs and time series as Spark DataFrame jobs."""
