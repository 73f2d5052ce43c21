"""Reusable relational operators: classify, latest version, merge, previous value."""
