"""Readers: typed CSV feeds, published tables, databases, feeds derived from test tables."""
