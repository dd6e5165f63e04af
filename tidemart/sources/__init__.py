"""File-backed sources and versioned Parquet tables."""
