"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlake.sinks.settle import settle

_ROW, _TIMES = "_row_of_key", "_times"


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """The first row of each key under a total order.

    `order` ranks the rows of one key; every remaining column follows as a tie
    break, so the survivor is the same on every run. The filter on rank 1 makes
    Spark keep one row per key and map task *before* the shuffle, so a key that
    holds a large part of the input never reaches one reducer whole.
    """
    rest = [F.col(name).asc_nulls_last() for name in df.columns if name not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*order, *(rest or [F.col(keys[0])]))
    return df.withColumn(_ROW, F.row_number().over(ranked)).where(F.col(_ROW) == 1).drop(_ROW)


def latest_per_key(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """The row with the greatest `by` of each key; rows without a `by` come last."""
    return first_per_key(df, keys, order=[F.col(by).desc_nulls_last()])


def settled_first_per_key(
    df: DataFrame, keys: Sequence[str], label: str, order: Sequence[Column] = (), most: int = 1_000_000
) -> DataFrame:
    """`first_per_key`, but only rows whose key comes more than once are sorted and shuffled.

    The rows are settled first, then the keys that come more than once; the shuffle for
    these carries keys alone. Beyond `most` such keys, too many to broadcast, all rows are ranked.
    """
    stored = settle(df, f"{label}-rows")
    times = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias(_TIMES))
    repeated = settle(times.where(F.col(_TIMES) > 1).select(*keys), f"{label}-repeated")
    if repeated.count() > most:
        return first_per_key(stored, keys, order)

    def having(how: str) -> DataFrame:
        same = [F.col(f"r.`{k}`").eqNullSafe(F.col(f"k.`{k}`")) for k in keys]
        return stored.alias("r").join(F.broadcast(repeated).alias("k"), reduce(Column.__and__, same), how)

    return having("left_anti").unionByName(first_per_key(having("left_semi"), keys, order))
