"""Readers for cell stores, wide tables, JDBC, Hive, delimited text and libsvm."""
