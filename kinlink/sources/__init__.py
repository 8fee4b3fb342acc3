"""Readers and writers: raw and truth files, Parquet stages, exports, reports."""
