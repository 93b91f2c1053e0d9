"""Writers: files, tables, JDBC, message logs, wide-column cells, keyed mutations."""
