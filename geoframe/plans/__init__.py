"""Registered queries: each applies one operator to the given tables, with the SQL that states its result."""
