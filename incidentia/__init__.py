"""Incident analytics on PySpark: clean, classify, count, filter, stream."""
