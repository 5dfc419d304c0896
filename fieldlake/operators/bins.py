"""Means over fixed and quantile bins. Bins are closed on the right."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.functions import mean
from fieldlake.operators.groups import labelled
from fieldlake.operators.quantiles import approximate_quantiles, exact_quantiles
from fieldlake.sinks.settle import settle


def fixed_bins(
    df: DataFrame,
    column: str,
    edges: Sequence[float],
    labels: Sequence[str],
    value: str,
    label: str,
    output: str,
    places: int = 2,
) -> DataFrame:
    """Mean of `value` per bin `(low, high]`; empty bins stay, outside rows do not count."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per pair of neighbouring edges")
    x = F.col(column)
    bin_label: Column | None = None
    for low, high, name in zip(edges, edges[1:], labels):
        inside = (x > low) & (x <= high)
        bin_label = F.when(inside, name) if bin_label is None else bin_label.when(inside, name)
    means = (
        df.select(bin_label.alias(label), value)
        .where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(mean(value, places).alias(output))
    )
    return labelled(df, labels, label).join(means, label, "left").select("position", label, output)


def quantile_trend(
    df: DataFrame,
    group: str,
    column: str,
    value: str,
    output: str,
    bins: int = 5,
    exact: bool = True,
    places: int = 2,
) -> DataFrame:
    """Mean of `value` over quantile bins of `column`, per group.

    Equal neighbouring edges merge, so a group may have fewer bins. The first
    bin includes its lower edge. A group with one value has one bin, from that
    value to itself.
    """
    steps = [i / bins for i in range(bins + 1)]
    find = exact_quantiles if exact else approximate_quantiles
    # Read twice, for the edges and for the bins, so the plan behind `df` runs once.
    usable = settle(
        df.where(F.col(column).isNotNull()).select(group, F.col(column).cast("double").alias("_x"), F.col(value).alias("_value")),
        "points",
    ).withColumnRenamed("_value", value)
    edges = settle(
        find(usable, "_x", steps, [group])
        .select(F.col(group).alias("_group"), F.array_distinct("quantiles").alias("_edges"))
        .withColumn(
            "_edges",
            F.when(F.size("_edges") == 1, F.array_repeat(F.get("_edges", F.lit(0)), 2)).otherwise(F.col("_edges")),
        ),
        "edges",
    )
    below = sum(
        F.when(F.get("_edges", F.lit(i)) < F.col("_x"), 1).otherwise(0) for i in range(bins + 1)
    )
    return (
        usable.join(edges, F.col(group).eqNullSafe(F.col("_group")))
        .select(
            group,
            F.greatest(below, F.lit(1)).alias("bin"),
            F.col("_edges").alias("edges"),
            value,
        )
        .groupBy(group, "bin")
        .agg(
            F.min(F.get("edges", F.col("bin") - 1)).alias("low"),
            F.min(F.get("edges", F.col("bin"))).alias("high"),
            F.count(F.lit(1)).alias("rows_in_bin"),
            mean(value, places).alias(output),
        )
        .select(
            group,
            "bin",
            F.round("low", 6).alias("low"),
            F.round("high", 6).alias("high"),
            F.round((F.col("low") + F.col("high")) / 2, 6).alias("midpoint"),
            "rows_in_bin",
            output,
        )
    )
