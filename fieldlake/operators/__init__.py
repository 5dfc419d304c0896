"""Relational operators; every column name is a parameter."""
