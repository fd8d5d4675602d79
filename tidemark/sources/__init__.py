"""Scans and sinks: text submissions, partitioned Parquet tables, scratch."""
