"""The three rollup tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from fieldlake.contracts import ROLLUP_CLIMATE_RISK, ROLLUP_ENVIRONMENT, ROLLUP_YIELD_WEATHER, ROLLUPS
from fieldlake.functions import half_away, is_yes, mean, rate, same_text
from fieldlake.functions.exact import share
from fieldlake.operators.joins import star_join
from fieldlake.operators.ordered import running_totals
from fieldlake.sinks.settle import settle

# Exposure labels of the climate-risk rollup.
ALERT = "Flood/Cyclone Alert"
NO_ALERT = "No Alert"


def farm_weather(
    fact_yield: DataFrame,
    dim_farms: DataFrame,
    fact_weather: DataFrame,
    between: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Yield facts with their farm and the reading of their station.

    Columns that both facts have carry `_station` on the weather side. `between`
    is applied to the facts with their farm, before they meet the readings.
    """
    with_farm = star_join(fact_yield, dim_farms, "farm_id", "farm_id", "_farm")
    if between:
        with_farm = between(with_farm)
    return star_join(
        with_farm, fact_weather, "matched_station_code", "station_code", "_station"
    )


def alerted() -> Column:
    return is_yes("flood_warning") | is_yes("cyclone_alert")


#: Farm measures of the rollups by the names of their sums.
_MEASURES = {
    "profit": "profit_loss_inr",
    "yield_gap": "yield_gap_tonnes",
    "health": "crop_health_score",
    "sustainability": "sustainability_score",
}


def farm_sums(joined: DataFrame) -> DataFrame:
    """Sums and counts per state, crop and exposure of farms with their reading: both farm rollups follow from them."""
    measures = {
        "gap": F.col("farm_reported_rainfall_mm") - F.col("rainfall_mm"),
        "rainfall": F.col("rainfall_mm"),
        **{name: F.col(column) for name, column in _MEASURES.items()},
    }
    exposure = F.when(alerted(), ALERT).otherwise(NO_ALERT)
    return joined.groupBy("state", "crop", exposure.alias("exposure_flag")).agg(
        *[F.sum(value).alias(f"sum_{name}") for name, value in measures.items()],
        *[F.count(value).alias(f"n_{name}") for name, value in measures.items()],
        F.count(F.lit(1)).alias("farms"),
        F.count_if(is_yes("pest_attack")).alias("pests"),
    )


def station_sums(farms: DataFrame) -> DataFrame:
    """Sums and counts of farm measures per state, crop and station, farms without a station left out.

    The farm join stays in place, as both tables are bucketed by farm; what the readings
    meet afterwards is one row per state, crop and station, also where one
    station serves most farms.
    """
    measures = {"reported": "farm_reported_rainfall_mm", **_MEASURES}
    matched = farms.where(F.col("matched_station_code").isNotNull())
    return matched.groupBy("state", "crop", "matched_station_code").agg(
        *[F.sum(column).alias(f"sum_{name}") for name, column in measures.items()],
        *[F.count(column).alias(f"n_{name}") for name, column in measures.items()],
        F.count(F.lit(1)).alias("farms"),
        F.count_if(is_yes("pest_attack")).alias("pests"),
    )


def exposure_sums(joined: DataFrame) -> DataFrame:
    """`farm_sums` from `station_sums` that have met the readings.

    A station's rain counts once for each of its farms: with n farms that reported
    rain, the sum of the gaps is the sum of what they reported less n times the
    station's rain. All of it in decimals, so the sums are those of the row by row join.
    """
    rain, measured = F.col("rainfall_mm"), F.col("rainfall_mm").isNotNull()

    def times(count: str) -> Column:
        return rain * F.col(count).cast(DecimalType(18, 0))

    totals = {
        # Of no value there is no sum, as in a sum over rows.
        "gap": (F.when(measured, F.col("sum_reported") - times("n_reported")), F.when(measured, F.col("n_reported"))),
        "rainfall": (times("farms"), F.when(measured, F.col("farms"))),
        **{name: (F.col(f"sum_{name}"), F.col(f"n_{name}")) for name in _MEASURES},
    }
    exposure = F.when(alerted(), ALERT).otherwise(NO_ALERT)
    sums = joined.groupBy("state", "crop", exposure.alias("exposure_flag")).agg(
        *[F.sum(total).alias(f"sum_{name}") for name, (total, _) in totals.items()],
        *[F.coalesce(F.sum(n), F.lit(0)).alias(f"n_{name}") for name, (_, n) in totals.items()],
        F.sum("farms").alias("farms"),
        F.sum("pests").alias("pests"),
    )
    # Sums of sums and products are no wider than one sum over all rows.
    kind = {"gap": DecimalType(29, 2), **{name: DecimalType(28, 2) for name in ("rainfall", *_MEASURES)}}
    narrow = [name for name in totals if isinstance(sums.schema[f"sum_{name}"].dataType, DecimalType)]
    return sums.withColumns({f"sum_{name}": F.col(f"sum_{name}").cast(kind[name]) for name in narrow})


def _total(sums: DataFrame, name: str) -> Column:
    """The exact sum of a measure over the rows of a group of sums."""
    total, kind = F.sum(f"sum_{name}"), sums.schema[f"sum_{name}"].dataType
    # Sums of sums are no wider than one sum over all rows.
    return total.cast(kind) if isinstance(kind, DecimalType) else total


def _average(sums: DataFrame, name: str, places: int = 2) -> Column:
    return F.round(F.try_divide(_total(sums, name), F.sum(f"n_{name}")), places).cast("double")


def _ratio_of_means_percent(sums: DataFrame, part: str, whole: str) -> Column:
    """100 * mean(part) / mean(whole); null when the second mean is 0."""
    def average(name: str) -> Column:
        return F.try_divide(_total(sums, name).cast("double"), F.sum(f"n_{name}").cast("double"))

    return half_away(F.try_divide(average(part), average(whole)) * 100)


def yield_weather(sums: DataFrame) -> DataFrame:
    """State x crop: how far farm-reported rain is off, mean profit, mean yield gap."""
    return sums.groupBy("state", "crop").agg(
        _ratio_of_means_percent(sums, "gap", "rainfall").alias("rainfall_reporting_gap_pct"),
        _average(sums, "profit").alias("avg_profit_loss_inr"),
        _average(sums, "yield_gap").alias("avg_yield_gap_tonnes"),
    )


def climate_risk(sums: DataFrame) -> DataFrame:
    """State x crop x exposure: share of farms with pests, mean scores."""
    return sums.groupBy("state", "crop", "exposure_flag").agg(
        share(F.sum("pests"), F.sum("farms")).alias("pest_attack_rate_pct"),
        _average(sums, "health").alias("avg_crop_health_score"),
        _average(sums, "sustainability").alias("avg_sustainability_score"),
    )


def environment(climate: DataFrame) -> DataFrame:
    """Country x climate zone: mean air measures, share of high disaster risk."""
    return climate.groupBy("country", "climate_zone").agg(
        mean("air_quality_index").alias("avg_air_quality_index"),
        mean("co2_ppm").alias("avg_co2_ppm"),
        mean("methane_ppb").alias("avg_methane_ppb"),
        rate(same_text("disaster_risk", "High")).alias("high_disaster_risk_pct"),
    )


def number_rows(rollup: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Surrogate key 1..n in key order, nulls last.

    Rows are numbered within ranges of the key, after the sizes of the ranges before; only
    one row a range meets in a task.
    """
    # Ranges and windows order nulls first, so a mark goes before each key.
    marks = {f"_no_{key}": F.col(key).isNull() for key in keys}
    order = [column for key in keys for column in (f"_no_{key}", key)]
    numbered = running_totals(rollup.withColumns(marks), order, {name: F.lit(1).cast("long")})
    return numbered.select(name, *rollup.columns)


def rollup_bodies(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The rollups without their surrogate keys; the farm sums are stored once for two of them."""
    joined = farm_weather(
        star["fact_crop_yield"], star["dim_farms"], star["fact_weather_observations"], station_sums
    )
    sums = settle(exposure_sums(joined), "farm-sums")
    return {
        ROLLUP_YIELD_WEATHER.name: yield_weather(sums),
        ROLLUP_CLIMATE_RISK.name: climate_risk(sums),
        ROLLUP_ENVIRONMENT.name: environment(star["fact_global_climate_environment"]),
    }


def build_rollups(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        name: number_rows(body, ROLLUPS[name].key, ROLLUPS[name].columns[0])
        for name, body in rollup_bodies(star).items()
    }
