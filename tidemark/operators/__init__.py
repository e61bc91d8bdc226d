"""DataFrame -> DataFrame operators: page logs, DAU, serving, change records, sales, search."""
