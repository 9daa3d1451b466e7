"""Segment analytics on Spark."""
