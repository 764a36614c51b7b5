"""Sinks: keyed tables, JDBC tables, topics."""
