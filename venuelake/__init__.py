"""Hospitality analytics as Spark jobs: ingestion, merges, classifiers and reports."""
