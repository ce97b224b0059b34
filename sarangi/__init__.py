"""Sarangi: a Spark engine for text corpora."""
