"""Annotation-run analytics on Spark."""
