"""Work-order inputs derived from the given tables, for the registered queries and tests."""
