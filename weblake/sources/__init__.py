"""Readers: driver-table fixtures, JDBC, access logs, CSV imports, gold tables."""
