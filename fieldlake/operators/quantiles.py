"""Quantiles per group: exact ones by refining histograms, approximate ones by a sketch.

An exact quantile is a value of a known rank. Values are counted per group in
equal cells between the least and the greatest of all; the cells that hold a wanted rank
are divided again, between the least and the greatest value they hold, as often as the size
of the input asks for; the distinct values of the last cells then give the
answer. Every step is an aggregate that tasks combine first, over rows joined to
a few cells a group: nothing is sorted globally, and no large group comes together in a
task. An input that is as small as a last cell may be needs no division.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlake.sinks.settle import settle, stored_bytes

_VALUE, _BASE, _CELL = "_value", "_base", "_cell"
_CELLS = 4096
#: Bytes of stored input whose distinct values the last step may hold for one cell.
_LAST_BYTES = 16 << 20


def _limits() -> list[Column]:
    """Least and greatest value, of all and of finite ones; NaN is greatest."""
    x = F.col(_VALUE)
    finite = F.when(F.abs(x) < float("inf"), x)
    return [F.min(x).alias("_low"), F.max(x).alias("_high"), F.min(finite).alias("_from"), F.max(finite).alias("_to")]


def _cell(cells: int) -> Column:
    """Number of the equal cell between `_from` and `_to` that holds a value; it never falls as values rise.

    Infinite values and NaN have cells of their own. Halves keep the span of very large values finite.
    """
    x, first, last = F.col(_VALUE), F.col("_from"), F.col("_to")
    place = F.try_divide(x / 2 - first / 2, last / 2 - first / 2) * cells
    return (
        F.when(F.isnan(x), cells + 1)
        .when(x == float("inf"), cells)
        .when(x == float("-inf"), -1)
        .otherwise(F.least(F.floor(F.coalesce(place, F.lit(0.0))), F.lit(cells - 1)))
        .cast("int")
    )


def _ranks(probabilities: Sequence[float]) -> Column:
    """Ranks, from 0, of the values between which the quantiles of `n` values lie."""
    positions = [F.lit(float(p)) * (F.col("n") - 1) for p in probabilities]
    return F.array_distinct(F.array(*[f(p).cast("long") for p in positions for f in (F.floor, F.ceil)]))


def _inside(values: DataFrame, cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Each value with the cell that holds it, if it is in one of them."""
    named = cells.withColumnsRenamed({name: f"_of_{name}" for name in by})
    within = F.col(_VALUE).between(F.col("_low"), F.col("_high"))
    if not by:
        # At most two cells a probability.
        return values.join(F.broadcast(named), within)
    same = [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in by]
    return values.join(named, [*same, within]).drop(*[f"_of_{name}" for name in by])


def _refined(values: DataFrame, cells: DataFrame | None, by: Sequence[str], ranks: Column, count: int) -> DataFrame:
    """The cells, one step finer, that hold a wanted rank, with the rank of their first value."""
    if cells is None:
        limits = values.agg(*_limits()).first()
        spanned = values.select("*", F.lit(limits["_from"]).alias("_from"), F.lit(limits["_to"]).alias("_to"))
        counted = spanned.groupBy(*by, _cell(count).alias(_CELL)).agg(F.count(F.lit(1)).alias("_rows"), *_limits())
        whole = Window.partitionBy(*by)
        counted = counted.select("*", F.sum("_rows").over(whole).alias("n"), F.lit(0).cast("long").alias(_BASE))
    else:
        counted = (
            _inside(values, cells, by)
            .groupBy(*by, _BASE, "n", _cell(count).alias(_CELL))
            .agg(F.count(F.lit(1)).alias("_rows"), *_limits())
        )
    # At most `count` and three rows a window.
    before = Window.partitionBy(*by, _BASE).orderBy(_CELL).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col(_BASE) + F.coalesce(F.sum("_rows").over(before), F.lit(0))
    placed = counted.select("*", first.alias("_first")).withColumn("_ranks", ranks)
    holds = F.exists("_ranks", lambda r: (r >= F.col("_first")) & (r < F.col("_first") + F.col("_rows")))
    return placed.where(holds).select(*by, F.col("_first").alias(_BASE), "n", "_low", "_high", "_from", "_to")


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = (),
    rounds: int | None = None, cells: int = _CELLS,
) -> DataFrame:
    """Linearly interpolated quantiles of `value` per group, one array per group.

    Adds `quantiles` (in the order of `probabilities`) and `n`, the number of
    values; rows without a value do not count. `df` is read once for the values'
    limits, once a round and once for the answer; the result is exact after any
    number of `rounds`, which follow from the size of the files behind `df`.
    """
    by = list(by)
    if rounds is None:
        size = stored_bytes(df.sparkSession, df)
        rounds = math.ceil(math.log(size / _LAST_BYTES, cells)) if size > _LAST_BYTES else 0
    values = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias(_VALUE))
    ranks = _ranks(probabilities)
    held = None
    for _ in range(rounds):
        held = settle(_refined(values, held, by, ranks, cells), "cells")

    if held is None:
        times = values.groupBy(*by, _VALUE).agg(F.count(F.lit(1)).alias("_times"))
        whole = F.sum("_times").over(Window.partitionBy(*by))
        times = times.select("*", F.lit(0).cast("long").alias(_BASE), whole.alias("n"))
    else:
        times = _inside(values, held, by).groupBy(*by, _BASE, "n", _VALUE).agg(F.count(F.lit(1)).alias("_times"))
    order = Window.partitionBy(*by, _BASE).orderBy(_VALUE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = times.withColumn("_end", F.col(_BASE) + F.sum("_times").over(order))
    first, last = F.col("_end") - F.col("_times"), F.col("_end")

    def at(position: Column) -> Column:
        return F.max(F.when((first <= position) & (position < last), F.col(_VALUE)))

    positions = [F.lit(float(p)) * (F.col("n") - 1) for p in probabilities]
    picks = [
        pick.alias(f"_{side}_{i}")
        for i, position in enumerate(positions)
        for side, pick in (("low", at(F.floor(position))), ("high", at(F.ceil(position))))
    ]

    def interpolated(i: int, position: Column) -> Column:
        low, high = F.col(f"_low_{i}"), F.col(f"_high_{i}")
        between = low + (high - low) * (position - F.floor(position))
        # Also where both are infinite.
        return F.when(low == high, low).otherwise(between)

    return ended.groupBy(*by, "n").agg(*picks).select(
        *by, "n", F.array(*[interpolated(i, position) for i, position in enumerate(positions)]).alias("quantiles")
    )


def approximate_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Like `exact_quantiles` from one pass with a bounded sketch per group."""
    return df.where(F.col(value).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx(
            F.col(value).cast("double"), [float(p) for p in probabilities], 10_000
        ).alias("quantiles"),
    )
