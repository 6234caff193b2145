"""JDBC tables and model folders."""
