"""Retail star-schema warehouse and sensor-stream counts on PySpark."""
