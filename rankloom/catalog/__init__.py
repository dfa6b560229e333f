"""The registered queries: each operator on the given tables, with the same query in SQL."""
