"""Whole jobs: the analysis tables, the batch load and its warehouse."""
