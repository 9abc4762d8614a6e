"""Layered analytics over nested records, written as PySpark DataFrame operations."""
