"""Declarative data tests; each returns the violating rows, so empty means pass."""
