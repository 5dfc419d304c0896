"""Correlations, distinct-value spread, samples."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pearson(a: str, b: str, places: int = 6) -> Column:
    """Correlation of the rows where both values exist; null when it is undefined."""
    x = F.when(F.col(b).isNotNull(), F.col(a))
    y = F.when(F.col(a).isNotNull(), F.col(b))
    # The built-in correlation raises on a constant column under ANSI rules.
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.round(r, places)


def pearson_complete(a: str, b: str, places: int = 6) -> Column:
    """`pearson` of columns without nulls: a column's deviation is computed once for all pairs."""
    return F.round(F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)), places)


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], complete: bool = False) -> DataFrame:
    """One row (a, b, r) per pair, all from a single pass.

    `complete` says that no column has nulls, as a contract may declare; it
    takes far fewer aggregates.
    """
    of = pearson_complete if complete else pearson
    used = dict.fromkeys(name for pair in pairs for name in pair)
    numbers = df.select(*[F.col(name).cast("double").alias(name) for name in used])
    wide = numbers.agg(*[of(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
                    for i, (a, b) in enumerate(pairs)
                ]
            )
        )
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str], complete: bool = False) -> DataFrame:
    """Lower triangle of the correlation matrix in long form."""
    return correlations(df, [(b, a) for a, b in combinations(columns, 2)], complete)


def attribute_spread(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Distinct values of each attribute per key, and whether any has more than one."""
    counts = df.groupBy(key).agg(
        *[F.count_distinct(name).alias(f"{name}_values") for name in attributes]
    )
    return counts.withColumn(
        "unstable", F.greatest(*[F.col(f"{name}_values") for name in attributes]) > 1
    )


def stable_sample(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """`size` rows without replacement; the same rows for the same key values and seed.

    Rows are drawn by the MD5 of "key:seed", which every engine has, so
    partitioning and row order do not matter and every task forwards at most
    `size` rows.
    """
    drawn = F.md5(F.concat_ws(":", F.col(key), F.lit(seed)))
    return df.orderBy(drawn, key).limit(size)


def largest(df: DataFrame, value: str, tie: str, size: int) -> DataFrame:
    """The `size` rows with the greatest value; equal values by ascending tie column."""
    return df.orderBy(F.col(value).desc_nulls_last(), F.col(tie).asc_nulls_last()).limit(size)


def preview(df: DataFrame, key: str, size: int = 5) -> DataFrame:
    """The first `size` rows in key order."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(size)
