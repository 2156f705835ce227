"""JSON event streams to scored, queryable tables, as plain Spark DataFrame code."""
