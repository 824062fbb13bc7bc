"""Bronze ingest as a file stream."""
