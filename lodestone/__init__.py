"""Spark-first curation analytics engine: registry queries over urls, files, pages, batches and events."""
