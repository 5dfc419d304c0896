"""Every query by name. Each takes (spark, source_dir) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from fieldlake.contracts import FACT_YIELD, ROLLUPS, STAR, conform
from fieldlake.functions import text
from fieldlake.operators import resolve
from fieldlake.operators.dedup import first_per_key
from fieldlake.operators.stats import attribute_spread, preview, stable_sample
from fieldlake.plans import analysis, charts, checks, model, quality
from fieldlake.plans.lake import Lake
from fieldlake.plans.rollups import farm_weather

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Callable[[Lake], DataFrame]] = {}

SAMPLE_SIZE, SAMPLE_SEED = 200, 42


def query(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text, which engines print alike."""
    def plain(field) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, DateType):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[plain(field) for field in df.schema])


def all_queries() -> dict[str, Query]:
    def bind(build: Callable[[Lake], DataFrame]) -> Query:
        return lambda spark, source_dir: portable(Lake.of(spark, source_dir).answer(build.__name__, build))

    return {name: bind(build) for name, build in QUERIES.items()}


def joined(lake: Lake) -> DataFrame:
    return farm_weather(lake.fact_yield, lake.dim_farms, lake.fact_weather)


def readings(lake: Lake) -> DataFrame:
    return lake.stations.select("station_code", "state", "observation_date")


# Sources and cleaning --------------------------------------------------------


@query
def ingest_row_counts(lake):
    return lake.row_counts(["feed_farms", "feed_stations", "feed_climate"], "feed")


@query
def dedup_by_key(lake):
    return first_per_key(lake.feed("feed_farms"), ["farm_id"])


@query
def dedup_composite_key(lake):
    lineitem = lake.spark.read.parquet(f"{lake.source_dir.rstrip('/')}/lineitem.parquet")
    return first_per_key(
        lineitem.withColumn("l_shipdate", F.col("l_shipdate").cast("date")),
        ["l_orderkey", "l_linenumber"],
    )


@query
def standardize_text(lake):
    feed = lake.feed("feed_farms").select("farm_id", "state", "district", "crop")
    return text.upper_columns(feed, ["state", "district", "crop"])


@query
def parse_dates(lake):
    # `season` is not a date: text that does not parse becomes null.
    feed = lake.feed("feed_farms").select("farm_id", "sowing_date", "harvesting_date", "season")
    return text.parse_dates(feed, ["sowing_date", "harvesting_date", "season"])


@query
def clean_farms(lake):
    return model.clean_farms(lake.feed("feed_farms"))


@query
def clean_stations(lake):
    return model.clean_stations(lake.feed("feed_stations"))


@query
def clean_climate(lake):
    return model.clean_climate(lake.feed("feed_climate"))


# Star ------------------------------------------------------------------------


@query
def dim_farms(lake):
    return model.dim_farms(lake.farms)


@query
def dim_stations(lake):
    return model.dim_stations(lake.stations)


@query
def latest_per_station(lake):
    return model.fact_weather(lake.stations)


@query
def weather_for_known_stations(lake):
    return model.weather_of_known_stations(lake.stations, lake.dim_stations)


@query
def match_exact(lake):
    farms = lake.farms.select("farm_id", "state", "district")
    return resolve.match_exact(farms, lake.dim_stations).select(
        "farm_id", "state", "district", "matched_station_code"
    )


@query
def match_unmatched(lake):
    farms = lake.farms.select("farm_id", "state", "district")
    return resolve.match_unmatched(farms, lake.dim_stations).select("farm_id", "state", "district")


@query
def unmatched_places(lake):
    return resolve.unmatched_places(lake.farms, lake.dim_stations)


@query
def match_nearest_in_group(lake):
    farms = resolve.match_unmatched(
        lake.farms.select("farm_id", "state", "district", "sowing_date"), lake.dim_stations
    ).select("farm_id", "state", "sowing_date")
    return resolve.match_nearest(farms, readings(lake))


@query
def match_two_tier(lake):
    farms = lake.farms.select("farm_id", "state", "district", "sowing_date")
    return resolve.resolve_tiers(farms, lake.dim_stations, readings(lake))


@query
def match_type_counts(lake):
    return lake.fact_yield.groupBy("match_type").agg(F.count(F.lit(1)).alias("farms"))


@query
def fact_crop_yield(lake):
    return model.fact_crop_yield(model.match_farms(lake.farms, lake.stations, lake.dim_stations))


@query
def fact_global_climate_environment(lake):
    return model.fact_climate(model.clean_climate(lake.feed("feed_climate")))


@query
def yield_gap(lake):
    return lake.fact_yield.select(
        "farm_id",
        "expected_yield_tonnes",
        "actual_yield_tonnes",
        model.yield_gap("expected_yield_tonnes", "actual_yield_tonnes").alias("yield_gap_tonnes"),
    )


@query
def conform_yield_contract(lake):
    return conform(lake.fact_yield, FACT_YIELD)


@query
def farm_weather_join(lake):
    return charts.rainfall_profit_points(joined(lake))


# Analysis questions ----------------------------------------------------------


@query
def avg_profit_by_state_crop(lake):
    return analysis.avg_profit_by_state_crop(lake.fact_yield, lake.dim_farms)


@query
def avg_profit_by_state(lake):
    return analysis.avg_profit_by_state(lake.fact_yield, lake.dim_farms)


@query
def top10_yield_gap(lake):
    return analysis.top_yield_gaps(lake.fact_yield, lake.dim_farms)


@query
def rainfall_gap_by_state(lake):
    return analysis.rainfall_gap_by_state(lake.fact_yield, lake.dim_farms, lake.fact_weather)


@query
def rank_crops(lake):
    return analysis.rank_crops_by_sustainability(lake.fact_yield, lake.dim_farms)


@query
def best_crop_per_state(lake):
    return analysis.best_crop_per_state(lake.fact_yield, lake.dim_farms)


@query
def compare_match_types(lake):
    return analysis.compare_match_types(lake.fact_yield)


@query
def running_avg_profit(lake):
    return analysis.running_avg_profit(lake.fact_yield)


@query
def states_without_alerts(lake):
    return analysis.states_without_alerts(lake.fact_yield, lake.dim_farms, lake.fact_weather)


@query
def pest_vs_health(lake):
    return analysis.pest_against_health(lake.fact_yield)


@query
def disaster_risk_share(lake):
    return analysis.disaster_risk_share(lake.fact_climate)


@query
def highest_yield_crop(lake):
    return analysis.highest_yield_crop(lake.fact_yield, lake.dim_farms)


# Rollups ---------------------------------------------------------------------


@query
def rollup_yield_weather(lake):
    return lake.rollups["yield_weather_correlation"].drop("correlation_id")


@query
def rollup_climate_risk(lake):
    return lake.rollups["climate_risk_farms"].drop("risk_id")


@query
def rollup_environment(lake):
    return lake.rollups["global_environment_summary"].drop("summary_id")


@query
def rollup_surrogate_key(lake):
    numbered = lake.rollups["climate_risk_farms"]
    return numbered.select("risk_id", "state", "crop", "exposure_flag")


# Dashboard tables ------------------------------------------------------------


@query
def overview_kpis(lake):
    return charts.overview(lake.fact_yield, lake.dim_farms)


@query
def profit_split(lake):
    return charts.profit_split(lake.fact_yield)


@query
def preview_farm_yield(lake):
    return preview(
        analysis.farm_yield(lake.fact_yield, lake.dim_farms).select(
            "farm_id", "state", "crop", "season", "profit_loss_inr", "match_type"
        ),
        "farm_id",
    )


@query
def preview_stations(lake):
    return preview(lake.dim_stations, "station_code")


@query
def preview_climate(lake):
    return preview(
        lake.fact_climate.select("observation_id", "date", "country", "air_quality_index"),
        "observation_id",
    )


def drawn_yields(lake: Lake) -> DataFrame:
    return stable_sample(
        lake.fact_yield.select("farm_id", "season", "expected_yield_tonnes", "actual_yield_tonnes"),
        "farm_id",
        SAMPLE_SIZE,
        SAMPLE_SEED,
    )


@query
def sample_yields(lake):
    return drawn_yields(lake)


@query
def sample_axis_max(lake):
    return charts.yield_axis_max(drawn_yields(lake))


@query
def yield_axis_max(lake):
    return charts.yield_axis_max(lake.fact_yield)


@query
def distinct_crops(lake):
    return charts.choices(lake.dim_farms, "crop")


@query
def default_crops(lake):
    return charts.default_choices(lake.dim_farms, "crop")


@query
def rainfall_gap_signed(lake):
    return charts.rainfall_gap_signed(joined(lake))


@query
def profit_trend_by_bin(lake):
    crops = charts.default_choices(lake.dim_farms, "crop")
    return charts.profit_trend(joined(lake), "Production Cost (INR)", crops)


@query
def profit_trend_by_rainfall(lake):
    return charts.profit_trend(joined(lake), "Official Station Rainfall (mm)")


@query
def profit_trend_by_land_area(lake):
    return charts.profit_trend(joined(lake), "Land Area (acres)")


@query
def pivot_crop_health(lake):
    return charts.crop_health_cells(analysis.farm_yield(lake.fact_yield, lake.dim_farms))


@query
def pest_rate_by_alert(lake):
    return charts.pest_rate_by_alert(joined(lake))


@query
def pest_impact(lake):
    return charts.pest_impact(lake.fact_yield)


@query
def pest_contrast(lake):
    return charts.pest_contrast(lake.fact_yield)


@query
def aqi_by_country(lake):
    return charts.aqi_by_country(lake.fact_climate)


@query
def risk_crosstab_pct(lake):
    return charts.risk_by_zone(lake.fact_climate)


@query
def drought_profile(lake):
    return charts.drought_profile(lake.fact_climate)


@query
def bin_temp_evapo(lake):
    return charts.evapotranspiration_by_temperature(lake.fact_climate)


@query
def bin_precip_aqi(lake):
    return charts.aqi_by_rain(lake.fact_climate)


@query
def correlation_matrix(lake):
    return charts.environment_correlations_of(lake.climate_moments)


@query
def named_correlations(lake):
    return charts.named_correlations(joined(lake), lake.fact_yield, lake.fact_climate, lake.climate_moments)


@query
def profit_identity_residual(lake):
    return charts.profit_identity_residual(lake.farms)


@query
def median_margin(lake):
    return charts.median_margin(lake.fact_yield)


# Quality ---------------------------------------------------------------------


@query
def unstable_ids(lake):
    return attribute_spread(
        lake.fact_climate, "station_id", ["country", "climate_zone", "latitude", "longitude"]
    )


@query
def stage_row_counts(lake):
    return lake.row_counts(
        ["feed_farms", "clean_farms", "feed_stations", "clean_stations", "feed_climate", *lake.star()], "table_name"
    )


@query
def dq_duplicate_keys(lake):
    return quality.duplicate_keys(lake.asked())


@query
def dq_unique_keys(lake):
    return quality.check_unique_keys(lake.asked())


@query
def dq_fallback_places(lake):
    return quality.check_fallback_places(lake.asked())


@query
def dq_unresolved(lake):
    return quality.check_unresolved(lake.asked())


@query
def dq_vocab_overlap(lake):
    return quality.check_season_words(lake.asked())


@query
def dq_station_ids(lake):
    return quality.check_station_ids(lake.asked())


@query
def dq_profit_rows(lake):
    return quality.check_profit_rows(lake.asked(), lake.farms)


@query
def dq_ph_range(lake):
    return quality.check_ph_range(lake.asked())


@query
def dq_large_gap(lake):
    return quality.check_rainfall_gap(lake.asked())


@query
def dq_orphans(lake):
    return quality.check_orphans(lake.asked())


@query
def dq_row_counts(lake):
    return quality.check_row_counts(lake.asked(), lake.farms)


@query
def dq_summary(lake):
    return quality.summarise(checks.run_standard(lake.star(), lake.farms))


@query
def contract_violations(lake):
    star = lake.star()
    tables = {**star, **lake.rollups}
    contracts = {**STAR, **ROLLUPS}
    return checks.contract_faults({name: tables[name] for name in contracts}, contracts)
