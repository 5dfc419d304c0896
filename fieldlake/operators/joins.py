"""Joins along the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.sinks.settle import settle


def star_join(
    fact: DataFrame, other: DataFrame, fact_key: str, other_key: str, suffix: str
) -> DataFrame:
    """Inner join in which columns of `other` that also exist in `fact` get a suffix.

    No hint: small tables broadcast by their stored size, bucketed ones join in
    place, the rest shuffles with adaptive skew splitting.
    """
    taken = set(fact.columns)
    if fact_key == other_key:
        renamed = {c: c + suffix for c in other.columns if c in taken and c != other_key}
        return fact.join(other.withColumnsRenamed(renamed), fact_key)
    renamed = {c: c + suffix for c in other.columns if c in taken}
    right = other.withColumnsRenamed(renamed)
    return fact.join(right, F.col(fact_key) == F.col(renamed.get(other_key, other_key)))


def not_in(left: DataFrame, column: str, excluded: DataFrame) -> DataFrame:
    """SQL `NOT IN` for one column; the excluded set is broadcast only if it is small.

    Like NOT IN, the result is empty when the set contains a null, and a null on
    the left only survives an empty set.
    """
    name = excluded.columns[0]
    listed = settle(excluded.select(F.col(name).alias("_excluded")).distinct(), "excluded")
    summary = listed.agg(
        F.count(F.lit(1)).alias("size"),
        F.count_if(F.col("_excluded").isNull()).alias("nulls"),
    )
    return left.join(listed, F.col(column) == F.col("_excluded"), "left_anti").where(
        (summary.select("nulls").scalar() == 0)
        & (F.col(column).isNotNull() | (summary.select("size").scalar() == 0))
    )


def orphans(fact: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Rows whose non-null key has no row in the dimension."""
    known = dimension.select(F.col(dimension_key).alias("_known"))
    return fact.where(F.col(key).isNotNull()).join(
        known, F.col(key) == F.col("_known"), "left_anti"
    )
