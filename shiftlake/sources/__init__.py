"""Sources: topics, JDBC dimensions, CSV tables, change feeds."""
