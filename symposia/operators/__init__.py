"""Relational operators of the discourse graph."""
