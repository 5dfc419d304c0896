"""Resolve rows to a provider: by place, else by the nearest date in the region.

Every tier is a lookup table keyed by what the answer depends on: the place,
the (region, date) pair, or the region. The rows to resolve are joined to these
lookups and never to the readings themselves, so no tier multiplies rows and
the work grows with rows + readings even when one region holds most of both.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlake.sinks.settle import settle

# The three match labels.
EXACT = "Exact District Match"
NEAREST = "Nearest In State"
UNRESOLVED = "Unresolved"

_DAY, _CODE, _ASKED = "_day", "_code", "_asked"


@dataclass(frozen=True)
class Keys:
    """Column names shared by the resolving operators.

    `place` and `region` are columns of both sides; `region` is the coarser of
    the two. `code` identifies a provider.
    """

    place: Sequence[str] = ("state", "district")
    region: Sequence[str] = ("state",)
    left_date: str = "sowing_date"
    right_date: str = "observation_date"
    code: str = "station_code"
    target: str = "matched_station_code"


def provider_by_place(providers: DataFrame, keys: Keys) -> DataFrame:
    """Smallest provider code of each place."""
    return providers.groupBy(*keys.place).agg(F.min(keys.code).alias(keys.target))


def match_exact(left: DataFrame, providers: DataFrame, keys: Keys = Keys()) -> DataFrame:
    """Rows whose place has a provider, with the smallest code of that place."""
    return left.join(settle(provider_by_place(providers, keys), "by-place"), list(keys.place))


def match_unmatched(left: DataFrame, providers: DataFrame, keys: Keys = Keys()) -> DataFrame:
    """Rows whose place has no provider."""
    places = settle(providers.select(*keys.place).distinct(), "places")
    return left.join(places, list(keys.place), "left_anti")


def unmatched_places(left: DataFrame, providers: DataFrame, keys: Keys = Keys()) -> DataFrame:
    """Distinct places of `left` that have no provider."""
    return match_unmatched(left.select(*keys.place).distinct(), providers, keys)


def nearest_by_date(left: DataFrame, readings: DataFrame, keys: Keys = Keys()) -> DataFrame:
    """(region, day) -> code of the reading closest in time, for every day in `left`.

    Equal distances go to the smallest code. Both sides first shrink to distinct
    (region, day) pairs, so a region holds at most one row per calendar day
    whatever the number of source rows. One forward and one backward pass over
    those days carry the neighbouring readings to each day asked for. (The
    backward pass is a running frame over descending days: a frame that reaches
    forward without end would rescan the rest of the region for every row.)
    """
    region = list(keys.region)
    offered = (
        readings.where(F.col(keys.right_date).isNotNull())
        .groupBy(*region, F.col(keys.right_date).alias(_DAY))
        .agg(F.min(keys.code).alias(_CODE))
        .withColumn(_ASKED, F.lit(False))
    )
    asked = (
        left.where(F.col(keys.left_date).isNotNull())
        .select(*region, F.col(keys.left_date).alias(_DAY))
        .distinct()
        .select("*", F.lit(None).cast("string").alias(_CODE), F.lit(True).alias(_ASKED))
    )
    days = (
        offered.unionByName(asked)
        .groupBy(*region, _DAY)
        .agg(F.max(_CODE).alias(_CODE), F.max(_ASKED).alias(_ASKED))
    )

    reading = F.when(F.col(_CODE).isNotNull(), F.struct(_DAY, _CODE))
    past = Window.partitionBy(*region).orderBy(_DAY)
    future = Window.partitionBy(*region).orderBy(F.desc(_DAY))

    def carried(frame: Window) -> Column:
        running = frame.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.last(reading, ignorenulls=True).over(running)

    def distance(name: str) -> Column:
        gap = F.abs(F.datediff(F.col(_DAY), F.col(f"{name}.{_DAY}")))
        return F.when(F.col(name).isNotNull(), F.struct(gap.alias("gap"), F.col(f"{name}.{_CODE}")))

    return (
        days.select("*", carried(past).alias("_before"), carried(future).alias("_after"))
        .where(F.col(_ASKED))
        .select(
            *region,
            F.col(_DAY).alias(keys.left_date),
            F.least(distance("_before"), distance("_after"))[_CODE].alias(keys.target),
        )
        .where(F.col(keys.target).isNotNull())
    )


def provider_by_region(readings: DataFrame, keys: Keys) -> DataFrame:
    """Smallest provider code of each region, for rows without a usable date."""
    return readings.groupBy(*keys.region).agg(F.min(keys.code).alias(keys.target))


def match_nearest(left: DataFrame, readings: DataFrame, keys: Keys = Keys()) -> DataFrame:
    """Rows whose region has a reading, with the code of the nearest one in time.

    A row without a date, or a region whose readings all lack one, takes the
    smallest code of the region. Rows of a region without readings are left out.
    """
    return _add_nearest(left, left, readings, keys, keys.target).where(
        F.col(keys.target).isNotNull()
    )


def _add_nearest(
    left: DataFrame, asking: DataFrame, readings: DataFrame, keys: Keys, target: str
) -> DataFrame:
    dated = settle(nearest_by_date(asking, readings, keys), "by-date")
    any_day = settle(provider_by_region(readings, keys), "by-region")
    return (
        left.join(
            dated.withColumnRenamed(keys.target, "_dated"),
            [*keys.region, keys.left_date],
            "left",
        )
        .join(any_day.withColumnRenamed(keys.target, "_any_day"), list(keys.region), "left")
        .select(*left.columns, F.coalesce("_dated", "_any_day").alias(target))
    )


def resolve_tiers(
    left: DataFrame, providers: DataFrame, readings: DataFrame, keys: Keys = Keys()
) -> DataFrame:
    """`left` plus the resolved code and the tier that resolved it.

    No row is dropped: rows of a region without readings stay, with a null code
    and the label for unresolved rows.
    """
    places = settle(provider_by_place(providers, keys), "by-place")
    asking = left.select(*dict.fromkeys([*keys.place, *keys.region, keys.left_date])).join(
        places, list(keys.place), "left_anti"
    )
    with_place = left.join(
        places.withColumnRenamed(keys.target, "_exact"), list(keys.place), "left"
    )
    exact, nearest = F.col("_exact"), F.col("_nearest")
    return _add_nearest(with_place, asking, readings, keys, "_nearest").select(
        *left.columns,
        F.coalesce(exact, nearest).alias(keys.target),
        F.when(exact.isNotNull(), EXACT)
        .when(nearest.isNotNull(), NEAREST)
        .otherwise(UNRESOLVED)
        .alias("match_type"),
    )
