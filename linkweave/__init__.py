"""Linked-read analytics on Spark."""
