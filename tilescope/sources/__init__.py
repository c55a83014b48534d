"""Readers and writers: raw CSV log, canvas views, Parquet export."""
