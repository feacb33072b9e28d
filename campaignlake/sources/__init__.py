"""Readers: delimited files, JSON messages, JDBC, driver-table projection."""
