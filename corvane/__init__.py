"""Corpus and schema metadata analytics as Spark DataFrame jobs."""
