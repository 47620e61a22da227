"""Readers: topics, files, JDBC dimensions and the Parquet test tables."""
