"""Composite jobs (ingest, compaction), parameterised SQL and the query registry."""
