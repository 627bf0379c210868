"""Readers and writers: parquet tables, TSV, line lists, predictions, stages."""
