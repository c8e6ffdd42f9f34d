"""Tidemill: medallion-style retail analytics as plain PySpark DataFrame functions."""
