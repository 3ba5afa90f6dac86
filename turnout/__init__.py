"""Incident response-time analytics on PySpark."""
