"""Readers: text, CSV, Parquet, zip archives, token files, vocabularies."""
