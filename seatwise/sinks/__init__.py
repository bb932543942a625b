"""Where results go: Parquet snapshots, or a database through staging tables."""
