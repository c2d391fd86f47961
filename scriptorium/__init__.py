"""Bibliographic analytics on Spark."""
