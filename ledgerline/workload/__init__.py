"""The library run on the given tables: records, queries and their SQL twins."""
