"""Governed sample lakehouse on Spark: ingest, lineage, Silver, Gold, checks, publication."""
