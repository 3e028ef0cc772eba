"""Readers: delimited text, catalog tables, JDBC tables and click streams."""
