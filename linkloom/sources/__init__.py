"""Readers and writers of the engine's text and Parquet tables."""
