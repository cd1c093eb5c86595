"""Spark building blocks for assembling code and text corpora."""
