"""Scans and sinks: driver tables, the derived ``rides`` binding, CSV/Parquet files."""
