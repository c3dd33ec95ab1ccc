"""Seal-placement analytics on Spark."""
