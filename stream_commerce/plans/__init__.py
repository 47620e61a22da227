"""Registered queries over the Parquet test tables and the SQL they are checked against."""
