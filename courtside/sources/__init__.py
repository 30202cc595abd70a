"""Sources: landed CSV snapshots, processed Parquet tables, stand-in tables."""
