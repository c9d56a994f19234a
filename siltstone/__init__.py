"""Medallion tables and text-term analytics as plain PySpark DataFrame functions."""
