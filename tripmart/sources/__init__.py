"""Readers: monthly archives, parquet zones, JDBC tables, parametrised SQL."""
