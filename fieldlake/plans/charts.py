"""The tables behind the dashboard's figures and charts, and the documented findings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.functions import is_yes, mean, rate, same_text
from fieldlake.operators.bins import fixed_bins, quantile_trend
from fieldlake.operators.groups import contrast, crosstab, means_by, ordered_means, widen
from fieldlake.operators.quantiles import exact_quantiles
from fieldlake.operators.moments import correlations_of, moments, triangle
from fieldlake.operators.stats import correlation_matrix, correlations
from fieldlake.plans.rollups import alerted

# ---------------------------------------------------------------------------
# Category orders, bin edges and labels, driver columns, measures.
# ---------------------------------------------------------------------------
DROUGHT_ORDER = ["Low", "Medium", "High"]
TEMPERATURE_EDGES = [-20, 0, 10, 20, 30, 50]
TEMPERATURE_LABELS = ["Below 0°C", "0-10°C", "10-20°C", "20-30°C", "Above 30°C"]
RAIN_EDGES = [-1, 10, 30, 50, 100]
RAIN_LABELS = [
    "Dry (0-10mm)",
    "Light Rain (10-30mm)",
    "Moderate Rain (30-50mm)",
    "Heavy Rain (50mm+)",
]
PROFIT_DRIVERS = {
    "Official Station Rainfall (mm)": "rainfall_mm",
    "Production Cost (INR)": "production_cost_inr",
    "Land Area (acres)": "land_area_acres",
}
ENVIRONMENT_MEASURES = [
    "avg_temperature_c",
    "evapotranspiration_mm",
    "precipitation_mm",
    "humidity_percent",
    "soil_moisture_percent",
    "air_quality_index",
    "pm25",
    "pm10",
]
ALERT_TRIGGERED = "Alert Triggered"
NO_ALERT = "No Alert"


def overview(fact_yield: DataFrame, dim_farms: DataFrame) -> DataFrame:
    """Farms, crop varieties, share of farms at a loss, stations in use: one row."""
    loss = F.coalesce(F.col("profit_loss_inr") < 0, F.lit(False))
    varieties = dim_farms.agg(F.count_distinct("crop_variety")).scalar()
    return fact_yield.agg(
        F.count(F.lit(1)).alias("total_farms"),
        rate(loss, places=1).alias("loss_pct"),
        F.count_distinct("matched_station_code").alias("stations_matched"),
    ).select("total_farms", varieties.alias("crop_varieties"), "loss_pct", "stations_matched")


def profit_split(fact_yield: DataFrame) -> DataFrame:
    """Farms with a loss and farms that break even or better, in one pass."""
    profit = F.col("profit_loss_inr")
    return fact_yield.agg(
        F.count_if(profit < 0).alias("loss_farms"), F.count_if(profit >= 0).alias("profit_farms")
    )


def choices(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def default_choices(df: DataFrame, column: str, size: int = 4) -> DataFrame:
    return choices(df, column).limit(size)


def rainfall_profit_points(joined: DataFrame) -> DataFrame:
    return joined.select(
        "farm_id", "state", "crop", "rainfall_mm", "farm_reported_rainfall_mm",
        "profit_loss_inr", "season", "season_station",
    )


def rainfall_gap_signed(joined: DataFrame) -> DataFrame:
    gap = F.col("farm_reported_rainfall_mm") - F.col("rainfall_mm")
    return means_by(joined, ["state"], {"rainfall_gap_mm": gap})


def profit_trend(
    joined: DataFrame, driver: str, crops: DataFrame | Sequence[str] | None = None, exact: bool = True
) -> DataFrame:
    """Mean profit over five quantile bins of a driver per crop.

    `driver` is one of the PROFIT_DRIVERS labels; `crops` a list or a one-column
    frame of crops to keep, all by default.
    """
    if driver not in PROFIT_DRIVERS:
        raise ValueError(f"unknown driver {driver!r}; choose from {list(PROFIT_DRIVERS)}")
    column = PROFIT_DRIVERS[driver]
    rows = joined.select("crop", column, "profit_loss_inr")
    if isinstance(crops, DataFrame):
        rows = rows.join(crops, "crop", "left_semi")
    elif crops is not None:
        rows = rows.where(F.col("crop").isin(*crops))
    return quantile_trend(
        rows, "crop", column, "profit_loss_inr", "avg_profit_loss_inr", exact=exact
    )


def crop_health_cells(farm_yield: DataFrame) -> DataFrame:
    """Mean crop health of every crop and state that occur together."""
    return means_by(farm_yield, ["crop", "state"], {"crop_health_score": "crop_health_score"})


def crop_health_matrix(farm_yield: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    """The cells as a matrix, one column per state."""
    return widen(crop_health_cells(farm_yield), "crop", "state", "crop_health_score", states)


def pest_rate_by_alert(joined: DataFrame) -> DataFrame:
    """Pest share among farms with a known pest flag, with and without alerts."""
    label = F.when(alerted(), ALERT_TRIGGERED).otherwise(NO_ALERT)
    yes, no = is_yes("pest_attack"), same_text("pest_attack", "No")
    return joined.groupBy(label.alias("has_alert")).agg(
        F.count_if(yes).alias("pest_yes"),
        F.count_if(no).alias("pest_no"),
        rate(yes, among=yes | no).alias("pest_attack_rate_pct"),
    )


def pest_impact(fact_yield: DataFrame) -> DataFrame:
    return means_by(
        fact_yield,
        ["pest_attack"],
        {"crop_health_score": "crop_health_score", "yield_gap_tonnes": "yield_gap_tonnes"},
    )


def pest_contrast(fact_yield: DataFrame) -> DataFrame:
    return contrast(
        fact_yield,
        "pest_attack",
        ["crop_health_score", "yield_gap_tonnes", "actual_yield_tonnes"],
    )


def aqi_by_country(climate: DataFrame) -> DataFrame:
    return climate.groupBy("country").agg(mean("air_quality_index").alias("air_quality_index"))


def risk_by_zone(climate: DataFrame) -> DataFrame:
    """Rows of every zone and risk level, and their percentage of the zone's rows with a level."""
    return crosstab(climate, "climate_zone", "disaster_risk")


def risk_matrix(climate: DataFrame, levels: Sequence[str] | None = None) -> DataFrame:
    """The percentages as a matrix, one column per level; absent pairs are 0."""
    return widen(risk_by_zone(climate), "climate_zone", "disaster_risk", "percent", levels, fill=0.0)


def drought_profile(climate: DataFrame) -> DataFrame:
    return ordered_means(
        climate, "drought_index", DROUGHT_ORDER, ["soil_moisture_percent", "precipitation_mm"]
    )


def evapotranspiration_by_temperature(climate: DataFrame) -> DataFrame:
    return fixed_bins(
        climate, "avg_temperature_c", TEMPERATURE_EDGES, TEMPERATURE_LABELS,
        "evapotranspiration_mm", "temp_range", "evapotranspiration_mm",
    )


def aqi_by_rain(climate: DataFrame) -> DataFrame:
    return fixed_bins(
        climate, "precipitation_mm", RAIN_EDGES, RAIN_LABELS,
        "air_quality_index", "precip_range", "air_quality_index",
    )


def environment_correlations(climate: DataFrame) -> DataFrame:
    """The contract declares every measure NOT NULL."""
    return correlation_matrix(climate, ENVIRONMENT_MEASURES, complete=True)


#: Pairs of one fact that the findings quote.
CLIMATE_PAIRS = [("avg_temperature_c", "evapotranspiration_mm"), ("precipitation_mm", "air_quality_index")]


def climate_moments(climate: DataFrame) -> DataFrame:
    """Moments by country of all environment measures and quoted pairs; the contract declares them NOT NULL."""
    matrix = triangle(ENVIRONMENT_MEASURES)
    known = {frozenset(pair) for pair in matrix}
    return moments(climate, "country", [*matrix, *(p for p in CLIMATE_PAIRS if frozenset(p) not in known)], complete=True)


def environment_correlations_of(parts: DataFrame) -> DataFrame:
    """`environment_correlations` of the countries whose moments are given."""
    return correlations_of(parts, triangle(ENVIRONMENT_MEASURES))


def named_correlations(
    joined: DataFrame, fact_yield: DataFrame, climate: DataFrame, parts: DataFrame | None = None
) -> DataFrame:
    """The six correlations that the findings quote; those of the climate from its moments, if given."""
    return (
        correlations(joined, [("rainfall_mm", "profit_loss_inr")])
        .unionByName(
            correlations(
                fact_yield,
                [
                    ("production_cost_inr", "profit_loss_inr"),
                    ("crop_health_score", "yield_gap_tonnes"),
                    ("expected_yield_tonnes", "actual_yield_tonnes"),
                ],
            )
        )
        .unionByName(correlations_of(parts, CLIMATE_PAIRS) if parts else correlations(climate, CLIMATE_PAIRS))
    )


def profit_identity_residual(farms: DataFrame) -> DataFrame:
    """Largest deviation of profit from price minus cost, on the raw doubles."""
    off = F.col("profit_loss_inr") - (F.col("market_price_inr") - F.col("production_cost_inr"))
    return farms.agg(F.max(F.abs(off)).alias("max_residual"))


def median_margin(fact_yield: DataFrame) -> DataFrame:
    """Median of profit as a percentage of price."""
    margin = F.try_divide(
        F.col("profit_loss_inr").cast("double"), F.col("market_price_inr").cast("double")
    )
    middle = exact_quantiles(fact_yield.select((margin * 100).alias("margin")), "margin", [0.5])
    return middle.select(F.round(F.col("quantiles")[0], 6).alias("median_margin_pct"))


def yield_axis_max(fact_yield: DataFrame) -> DataFrame:
    """Largest yield of the rows: of the whole table, or of a drawn sample for its chart's axis."""
    return fact_yield.agg(
        F.greatest(F.max("expected_yield_tonnes"), F.max("actual_yield_tonnes")).alias("axis_max")
    )
