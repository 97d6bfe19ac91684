"""Layered snapshot analytics on PySpark: land faithfully, type safely, reduce, answer."""
