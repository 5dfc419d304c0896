"""The quality suite as data: checks name measures, measures of one table come from one aggregate.

`quality` has each check as a query of its own. Here the ten standard checks are
rules, SQL text over named measures. A table is read once for all measures that its rows
give; what a check needs from another table joins as a small lookup, one row a key
whatever that table holds, so that a fault in one check's table never changes another's count.
The climate fact is read twice, for two groupings over different columns, the station
tables again where they serve as lookups, and the seasons from partition values.

Rules and measures are text because a plan of some hundred expressions is then
handed over in a few calls.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, VarcharType

from fieldlake.contracts import Contract
from fieldlake.operators.resolve import EXACT, UNRESOLVED
from fieldlake.plans.quality import Star, union_all


@dataclass(frozen=True)
class Rule:
    """A check: how many violations, and how much it looked at, over measures by name."""

    check_id: str
    violations: str
    observed: str


#: The checks of `quality.standard_checks`, in its order.
STANDARD = (
    Rule(
        "unique_keys",
        "dim_rows - dim_keys + station_rows - station_keys + fact_rows - fact_keys"
        " + reading_rows - reading_keys + climate_rows - climate_keys",
        "dim_rows + station_rows + fact_rows + reading_rows + climate_rows",
    ),
    Rule("fallback_places", "false_exact", "fallback_rows"),
    Rule("unresolved_farms", "mislabelled", "unresolved"),
    Rule("season_words", "shared_seasons", "farm_seasons"),
    Rule("unstable_station_ids", "0", "unstable_ids"),
    Rule("profit_rows", "abs(fact_profits - clean_profits)", "fact_profits"),
    Rule("soil_ph_range", "ph_outside", "ph_known"),
    Rule("rainfall_gap_over_20_pct", "0", "gaps"),
    Rule("orphans", "lost_stations + lost_farms + lost_readings", "resolved"),
    Rule("row_counts", "abs(clean_rows - fact_rows) + abs(clean_rows - dim_rows)", "clean_rows"),
)


def _agg(df: DataFrame, by: str | None = None, **measures: str) -> DataFrame:
    grouped = df.groupBy(by) if by else df
    return grouped.agg(*[F.expr(text).alias(name) for name, text in measures.items()])


def _large_gap(measured: str) -> str:
    """`quality.large_gap` as text."""
    farm = "farm_reported_rainfall_mm"
    return f"if({measured} = 0, abs({farm} - {measured}) > 0, abs({farm} - {measured}) * 100 > abs({measured}) * 20)"


def dimension_measures(star: Star) -> DataFrame:
    """Of the farm dimension, one row a farm: its rows, and whether a place of it has no station."""
    stations = star["dim_weather_stations"]
    places = stations.selectExpr("state", "district", "true AS has_station").where("state IS NOT NULL AND district IS NOT NULL").distinct()
    farms = star["dim_farms"].select("farm_id", "soil_ph", "state", "district")
    return _agg(
        farms.join(places, ["state", "district"], "left"), "farm_id",
        dim_rows="count(1)", without_station="max(has_station IS NULL)",
        ph_outside="count_if(NOT soil_ph BETWEEN 0 AND 14)", ph_known="count(soil_ph)",
    ).withColumnRenamed("farm_id", "dim_farm")


def fact_measures(star: Star) -> DataFrame:
    """Of the yield fact, one row a farm: counts over its rows, with lookups by station code."""
    readings = _agg(
        star["fact_weather_observations"].where("station_code IS NOT NULL").select("station_code", "rainfall_mm"),
        "station_code", rain="collect_list(rainfall_mm)",
    ).withColumnRenamed("station_code", "reading")
    known = star["dim_weather_stations"].selectExpr("station_code AS station").where("station IS NOT NULL").distinct()
    rows = star["fact_crop_yield"].select(
        "farm_id", "match_type", "matched_station_code", "profit_loss_inr", "farm_reported_rainfall_mm"
    )
    code = F.col("matched_station_code")
    joined = rows.join(known, code == F.col("station"), "left").join(readings, code == F.col("reading"), "left")
    # A station has one reading here, unless its key is not unique.
    gaps = f"CASE WHEN size(rain) = 1 THEN int({_large_gap('rain[0]')}) WHEN rain IS NOT NULL THEN size(filter(rain, r -> {_large_gap('r')})) END"
    return _agg(
        joined, "farm_id",
        fact_rows="count(1)",
        mislabelled=f"count_if((matched_station_code IS NULL) != (match_type <=> '{UNRESOLVED}'))",
        unresolved="count_if(matched_station_code IS NULL)",
        resolved="count(matched_station_code)",
        exact=f"count_if(match_type = '{EXACT}')",
        lost_stations="count_if(matched_station_code IS NOT NULL AND station IS NULL)",
        fact_profits="count_if(profit_loss_inr >= 0)",
        gaps=f"sum({gaps})",
    )


def measures(star: Star, farms: DataFrame) -> list[DataFrame]:
    """One-row frames; their columns are all measures of the standard checks."""
    facts, dims = fact_measures(star), dimension_measures(star)
    # Both sides have one row a farm and keep the tables' buckets.
    by_farm = _agg(
        facts.join(dims, F.col("farm_id") == F.col("dim_farm"), "full"),
        **{name: f"sum({name})" for name in (
            "fact_rows", "dim_rows", "mislabelled", "unresolved", "resolved", "lost_stations", "fact_profits", "gaps",
            "ph_outside", "ph_known",
        )},
        fact_keys="count(farm_id)",
        dim_keys="count(dim_farm)",
        lost_farms="sum(CASE WHEN farm_id IS NOT NULL AND dim_farm IS NULL THEN fact_rows END)",
        false_exact="sum(CASE WHEN farm_id IS NOT NULL AND without_station THEN exact END)",
        fallback_rows="sum(CASE WHEN farm_id IS NOT NULL AND without_station THEN fact_rows END)",
    )
    stations = _agg(star["dim_weather_stations"], "station_code", station_rows="count(1)")
    readings = _agg(star["fact_weather_observations"], "station_code", reading_rows="count(1)").withColumnRenamed("station_code", "code")
    by_station = _agg(
        readings.join(stations, F.col("code") == F.col("station_code"), "full"),
        station_rows="sum(station_rows)", reading_rows="sum(reading_rows)",
        station_keys="count(station_code)", reading_keys="count(code)",
        lost_readings="sum(CASE WHEN code IS NOT NULL AND station_code IS NULL THEN reading_rows END)",
    )
    seasons = star["fact_crop_yield"].selectExpr("season", "1 AS side").distinct().unionByName(
        star["fact_weather_observations"].selectExpr("season", "2 AS side").distinct()
    )
    words = _agg(
        _agg(seasons, "season", sides="sum(side)"), shared_seasons="count_if(sides = 3)", farm_seasons="count_if(sides != 2)"
    )
    climate = star["fact_global_climate_environment"]
    varies = " OR ".join(f"coalesce(min({a}) < max({a}), false)" for a in ("country", "climate_zone", "latitude", "longitude"))
    by_id = _agg(_agg(climate, "station_id", unstable=varies), unstable_ids="count_if(unstable)")
    observations = _agg(climate, climate_rows="count(1)", climate_keys="count(DISTINCT observation_id)")
    clean = _agg(farms, clean_rows="count(1)", clean_profits="count_if(profit_loss_inr >= 0)")
    return [by_farm, by_station, words, by_id, observations, clean]


def run_standard(star: Star, farms: DataFrame, rules: Sequence[Rule] = STANDARD) -> DataFrame:
    """All rules as rows (check_id, violations, observed, passed), from one aggregate a table."""
    frames = measures(star, farms)
    long = [
        frame.selectExpr(f"stack({len(frame.columns)}, " + ", ".join(f"'{c}', bigint({c})" for c in frame.columns) + ") AS (measure, value)")
        for frame in frames
    ]
    names = [c for frame in frames for c in frame.columns]
    wide = _agg(union_all(long), **{c: f"coalesce(max(CASE WHEN measure = '{c}' THEN value END), 0)" for c in names})
    told = ", ".join(f"'{r.check_id}', bigint({r.violations}), bigint({r.observed})" for r in rules)
    found = wide.selectExpr(f"stack({len(rules)}, {told}) AS (check_id, violations, observed)")
    return found.selectExpr("*", "violations = 0 AS passed")


# Contract checks -------------------------------------------------------------

_KINDS = ("nulls", "too_long", "out_of_range")


def _faults(field: StructField) -> dict[str, str]:
    """What may be wrong with a column's value, by kind."""
    found = {}
    if not field.nullable:
        found["nulls"] = f"`{field.name}` IS NULL"
    if isinstance(field.dataType, VarcharType):
        found["too_long"] = f"coalesce(length(`{field.name}`) > {field.dataType.length}, false)"
    if isinstance(field.dataType, DecimalType):
        limit = 10 ** (field.dataType.precision - field.dataType.scale)
        found["out_of_range"] = f"coalesce(abs(round(`{field.name}`, {field.dataType.scale})) >= {limit}, false)"
    return found


def contract_faults(tables: dict[str, DataFrame], contracts: dict[str, Contract]) -> DataFrame:
    """`quality.contract_violations` of several tables in one result.

    Each table is read once. Rows are looked through as a whole, and only a row with a
    fault is taken apart, so a clean table costs a filter.
    """
    counted, declared = [], []
    for name, table in tables.items():
        fields = contracts[name].schema
        declared += [f"'{name}', '{f.name}'" for f in fields]
        faults = [(f.name, kind, fault) for f in fields for kind, fault in _faults(f).items()]
        if not faults:
            continue
        found = ", ".join(f"CASE WHEN {fault} THEN '{kind} {column}' END" for column, kind, fault in faults)
        broken = table.where(" OR ".join(f"({fault})" for *_, fault in faults))
        counted.append(broken.selectExpr(f"'{name}' AS table_name", f"explode(array({found})) AS fault"))
    spark = next(iter(tables.values())).sparkSession
    every = spark.sql(f"SELECT stack({len(declared)}, {', '.join(declared)}) AS (table_name, column_name)")
    faulty = union_all(counted).where("fault IS NOT NULL").groupBy("table_name", "fault").agg(F.expr("count(1) AS rows"))
    by_column = faulty.selectExpr("table_name", "split(fault, ' ', 2)[0] AS kind", "split(fault, ' ', 2)[1] AS column_name", "rows").groupBy(
        "table_name", "column_name"
    ).agg(*[F.expr(f"sum(if(kind = '{kind}', rows, 0L)) AS {kind}") for kind in _KINDS])
    return every.join(by_column, ["table_name", "column_name"], "left").selectExpr(
        "table_name", "column_name", *[f"coalesce({kind}, 0L) AS {kind}" for kind in _KINDS]
    )
