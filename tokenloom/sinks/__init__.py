"""Writers: token shards, CSV, Parquet, text, run metrics."""
