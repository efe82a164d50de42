"""Readers, writers and the derived clickstream input."""
