"""Readers: files, tables, JDBC, message logs, wide-column cells, entities."""
