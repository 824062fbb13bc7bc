"""Scans, manifests, incremental loads, control tables and sinks."""
