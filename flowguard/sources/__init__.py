"""Flow sources: CSV readers and the parquet test tables."""
