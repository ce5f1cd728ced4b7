"""Readers (text formats of the mining pipeline, Parquet) and the derived fixtures."""
