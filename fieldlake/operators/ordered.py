"""Operators that need one global order: running totals and averages. Quantiles need none, see `quantiles`.

A window without PARTITION BY sends every row to one task, and one with it
sends a whole group there. Here the rows are range-partitioned on the order
instead, each range adds up its own rows, and a table with one row per range
carries the totals of all earlier ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from fieldlake.operators.quantiles import approximate_quantiles, exact_quantiles  # noqa: F401
from fieldlake.sinks.settle import settle, stored_bytes

_PART = "_part"
_RANGE_BYTES = 64 << 20


def running_totals(
    df: DataFrame, order: Sequence[str], measures: dict[str, Column], keep_order: bool = False
) -> DataFrame:
    """Add to each row the sum of each measure over all rows up to and including it.

    `order` must identify a row. The range number of each row is written down
    once, so both passes below see the same ranges. There are as many ranges as
    shuffle partitions, or more if the files behind `df` are large, since a range
    is sorted by one task; the per-range totals have one row each, which bounds
    both the unpartitioned window over them and their broadcast.
    """
    # Ranges sort nulls first, as the windows below do.
    spark = df.sparkSession
    wanted = -(-stored_bytes(spark, df) // _RANGE_BYTES)
    more = [wanted] if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    ranged = (
        df.select("*", *[value.alias(f"_of_{name}") for name, value in measures.items()])
        .repartitionByRange(*more, *[F.col(name) for name in order])
        .withColumn(_PART, F.spark_partition_id())
    )
    rows = settle(ranged, "ranges")

    totals = rows.groupBy(_PART).agg(
        *[F.sum(f"_of_{name}").alias(f"_all_{name}") for name in measures]
    )
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        _PART, *[F.sum(f"_all_{name}").over(earlier).alias(f"_base_{name}") for name in measures]
    )

    if keep_order:
        # The windows accept this partitioning and so does the closing sort.
        rows = rows.repartitionByRange(_PART)
    within = (
        Window.partitionBy(_PART)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = rows.withColumns({f"_run_{n}": F.sum(f"_of_{n}").over(within) for n in measures})
    if keep_order:
        summed = summed.orderBy(_PART, *order)
    return summed.join(F.broadcast(offsets), _PART).select(
        *df.columns,
        *[
            (F.coalesce(F.col(f"_base_{n}"), F.lit(0)) + F.coalesce(F.col(f"_run_{n}"), F.lit(0)))
            .alias(n)
            for n in measures
        ],
    )


def running_average(
    df: DataFrame,
    order: str,
    tie: str,
    value: str,
    output: str,
    places: int = 2,
    scale: int = 2,
) -> DataFrame:
    """Average of `value` over all rows up to each row, in (`order`, `tie`) order.

    The result comes out in that order. Rows without a value keep the average
    reached so far.
    """
    exact = F.col(value).cast(DecimalType(18, scale))
    totals = running_totals(
        df,
        [order, tie],
        {"_total": exact, "_rows": F.when(exact.isNotNull(), 1).otherwise(0).cast("long")},
        keep_order=True,
    )
    average = F.try_divide(F.col("_total"), F.col("_rows"))
    return totals.select(*df.columns, F.round(average, places).cast("double").alias(output))
