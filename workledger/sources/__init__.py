"""Readers for event lines and reference files, and the batch checksum."""
