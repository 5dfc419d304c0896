"""The quality suite: each check is one row (check_id, violations, observed, passed)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, VarcharType

from fieldlake.contracts import Contract, STAR
from fieldlake.operators.joins import orphans, star_join
from fieldlake.operators.resolve import EXACT, UNRESOLVED
from fieldlake.sinks.settle import settle

Star = dict[str, DataFrame]


def verdict(df: DataFrame, check_id: str, violations: Column, observed: Column) -> DataFrame:
    """One result row from a one-row frame."""
    found = F.coalesce(violations, F.lit(0)).cast("long")
    return df.select(
        F.lit(check_id).alias("check_id"),
        found.alias("violations"),
        F.coalesce(observed, F.lit(0)).cast("long").alias("observed"),
        (found == 0).alias("passed"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(frames: dict[str, DataFrame], name: str = "table_name") -> DataFrame:
    """One row per frame: its label and its number of rows."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(label).alias(name), "rows")
            for label, df in frames.items()
        ]
    )


# Single-table checks ---------------------------------------------------------


def duplicate_keys(star: Star) -> DataFrame:
    """Rows beyond the first of each key, per table. Rows without a key count too."""
    def count(name: str, contract: Contract) -> DataFrame:
        key = [F.col(c) for c in contract.key]
        return star[name].agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct(*key).alias("keys")
        ).select(
            F.lit(name).alias("table_name"), "rows", "keys", (F.col("rows") - F.col("keys")).alias("duplicates")
        )

    return union_all([count(name, contract) for name, contract in STAR.items()])


def check_unique_keys(star: Star) -> DataFrame:
    found = duplicate_keys(star).agg(F.sum("duplicates").alias("d"), F.sum("rows").alias("r"))
    return verdict(found, "unique_keys", F.col("d"), F.col("r"))


def check_unresolved(star: Star) -> DataFrame:
    """Farms without a station carry the unresolved label, and only they do."""
    missing = F.col("matched_station_code").isNull()
    labelled = F.col("match_type").eqNullSafe(UNRESOLVED)
    found = star["fact_crop_yield"].agg(
        F.count_if(missing != labelled).alias("v"), F.count_if(missing).alias("o")
    )
    return verdict(found, "unresolved_farms", F.col("v"), F.col("o"))


def check_ph_range(star: Star, low: float = 0, high: float = 14) -> DataFrame:
    found = star["dim_farms"].agg(
        F.count_if(~F.col("soil_ph").between(low, high)).alias("v"),
        F.count("soil_ph").alias("o"),
    )
    return verdict(found, "soil_ph_range", F.col("v"), F.col("o"))


def check_station_ids(star: Star) -> DataFrame:
    """Climate station ids with more than one place or zone. Reported, not a failure:
    the ids label observations, not stations."""
    def varies(name: str) -> Column:
        # More than one distinct value, without keeping the values.
        return F.coalesce(F.min(name) < F.max(name), F.lit(False))

    attributes = ["country", "climate_zone", "latitude", "longitude"]
    per_id = star["fact_global_climate_environment"].groupBy("station_id").agg(
        reduce(lambda a, b: a | b, [varies(a) for a in attributes]).alias("unstable")
    )
    found = per_id.agg(F.count_if("unstable").alias("o"))
    return verdict(found, "unstable_station_ids", F.lit(0), F.col("o"))


# Checks across tables --------------------------------------------------------


def check_fallback_places(star: Star) -> DataFrame:
    """No farm of a place without a station may claim an exact match."""
    farms, stations = star["dim_farms"], star["dim_weather_stations"]
    place = ["state", "district"]
    without = settle(
        farms.select(*place).distinct().join(stations.select(*place).distinct(), place, "left_anti"),
        "places-without-station",
    )
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"p.{c}")) for c in place]
    affected = farms.alias("f").join(without.alias("p"), same, "left_semi").select("farm_id")
    found = star["fact_crop_yield"].join(affected, "farm_id", "left_semi").agg(
        F.count_if(F.col("match_type") == EXACT).alias("v"), F.count(F.lit(1)).alias("o")
    )
    return verdict(found, "fallback_places", F.col("v"), F.col("o"))


def check_season_words(star: Star) -> DataFrame:
    """Farm seasons and station seasons share no word."""
    farm = star["fact_crop_yield"].select("season").distinct()
    shared = farm.intersect(star["fact_weather_observations"].select("season").distinct())
    words = farm.agg(F.count(F.lit(1))).scalar()
    found = shared.agg(F.count(F.lit(1)).alias("v")).withColumn("o", words)
    return verdict(found, "season_words", F.col("v"), F.col("o"))


def check_profit_rows(star: Star, farms: DataFrame) -> DataFrame:
    """As many break-even-or-better farms in the facts as in the clean farms."""
    def profitable(df: DataFrame) -> DataFrame:
        return df.agg(F.count_if(F.col("profit_loss_inr") >= 0).alias("n"))

    before = profitable(farms).scalar()
    found = profitable(star["fact_crop_yield"]).withColumn("before", before)
    return verdict(found, "profit_rows", F.abs(F.col("n") - F.col("before")), F.col("n"))


def large_gap(threshold: float = 20) -> Column:
    """Reported rain off by more than `threshold` percent of the measured rain.

    Any difference from a station that measured nothing counts.
    """
    farm, station = F.col("farm_reported_rainfall_mm"), F.col("rainfall_mm")
    off = F.abs(farm - station)
    return F.when(station == 0, off > 0).otherwise(off * 100 > F.abs(station) * threshold)


def check_rainfall_gap(star: Star) -> DataFrame:
    """Farms whose reported rain is far off. Reported, not a failure."""
    joined = star_join(
        star["fact_crop_yield"].select("matched_station_code", "farm_reported_rainfall_mm"),
        star["fact_weather_observations"].select("station_code", "rainfall_mm"),
        "matched_station_code",
        "station_code",
        "_station",
    )
    found = joined.agg(F.count_if(large_gap()).alias("o"))
    return verdict(found, "rainfall_gap_over_20_pct", F.lit(0), F.col("o"))


def check_orphans(star: Star) -> DataFrame:
    """Facts that point to a station, a farm or a dimension row that does not exist."""
    facts = star["fact_crop_yield"]
    pairs = [
        (facts, "matched_station_code", star["dim_weather_stations"], "station_code"),
        (facts, "farm_id", star["dim_farms"], "farm_id"),
        (star["fact_weather_observations"], "station_code", star["dim_weather_stations"], "station_code"),
    ]
    counts = union_all(
        [orphans(*pair).agg(F.count(F.lit(1)).alias("n")) for pair in pairs]
    )
    total = facts.agg(F.count("matched_station_code")).scalar()
    found = counts.agg(F.sum("n").alias("v")).withColumn("o", total)
    return verdict(found, "orphans", F.col("v"), F.col("o"))


def check_row_counts(star: Star, farms: DataFrame) -> DataFrame:
    """One fact and one dimension row per clean farm."""
    def rows(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    found = farms.agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"facts": rows(star["fact_crop_yield"]), "dims": rows(star["dim_farms"])}
    )
    off = F.abs(F.col("n") - F.col("facts")) + F.abs(F.col("n") - F.col("dims"))
    return verdict(found, "row_counts", off, F.col("n"))


Check = Callable[[Star], DataFrame]


def standard_checks(farms: DataFrame) -> list[Check]:
    return [
        check_unique_keys,
        check_fallback_places,
        check_unresolved,
        check_season_words,
        check_station_ids,
        lambda star: check_profit_rows(star, farms),
        check_ph_range,
        check_rainfall_gap,
        check_orphans,
        lambda star: check_row_counts(star, farms),
    ]


def run_checks(star: Star, checks: Sequence[Check]) -> DataFrame:
    return union_all([check(star) for check in checks])


def summarise(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("executed"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


# Contract checks -------------------------------------------------------------


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Per declared column: missing values, over-long texts, out-of-range decimals.

    One pass over the table; the one-row result turns into a row per column.
    """
    def too_long(field) -> Column:
        if not isinstance(field.dataType, VarcharType):
            return F.lit(0).cast("long")
        return F.count_if(F.length(field.name) > field.dataType.length)

    def out_of_range(field) -> Column:
        if not isinstance(field.dataType, DecimalType):
            return F.lit(0).cast("long")
        limit = 10 ** (field.dataType.precision - field.dataType.scale)
        value = F.abs(F.round(F.col(field.name), field.dataType.scale))
        return F.count_if(value >= F.lit(limit).cast(DecimalType(20, 0)))

    def missing(field) -> Column:
        return F.lit(0).cast("long") if field.nullable else F.count_if(F.col(field.name).isNull())

    measured = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(field.name).alias("column_name"),
                    missing(field).alias("nulls"),
                    too_long(field).alias("too_long"),
                    out_of_range(field).alias("out_of_range"),
                )
                for field in contract.schema
            ]
        ).alias("found")
    )
    return measured.select(F.inline("found")).select(
        F.lit(contract.name).alias("table_name"), "column_name", "nulls", "too_long", "out_of_range"
    )


def same_columns(df: DataFrame, contract: Contract) -> bool:
    """Declared columns in declared order, nothing else."""
    return df.columns == contract.columns
