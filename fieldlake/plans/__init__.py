"""Composite plans: cleaning, the star schema, rollups, analysis, quality."""
