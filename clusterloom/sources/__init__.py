"""Delimited files, JDBC tables and literal rows as DataFrames."""
