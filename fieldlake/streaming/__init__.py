"""Refresh driven by newly arrived files."""
