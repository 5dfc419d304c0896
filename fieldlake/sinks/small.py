"""Small results: one-file logs and summaries, and named views."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_log(results: DataFrame, path: str) -> None:
    """A check log as one CSV file with a header. For results of a few rows."""
    results.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_summary(summary: DataFrame, path: str) -> DataFrame:
    """A small summary as one Parquet file, read back."""
    summary.coalesce(1).write.mode("overwrite").parquet(path)
    return summary.sparkSession.read.parquet(path)


def create_view(df: DataFrame, name: str) -> None:
    """Create or replace a view; reading it recomputes the query."""
    df.createOrReplaceTempView(name)
