"""Scans and sinks: raw CSV, catalogued tables, and the supplied Parquet tables."""
