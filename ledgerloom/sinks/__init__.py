"""Catalog tables and Parquet outputs: create, append by name, insert by position, overwrite."""
