"""Scans and sinks: landed envelopes, API answers, parquet tables, run log, charts."""
