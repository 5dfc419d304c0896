"""Raw feeds to clean tables to the star schema. Everything here is lazy except
the small lookups of the station match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.contracts import (
    CLIMATE_FEED,
    DIM_FARMS,
    DIM_STATIONS,
    FACT_CLIMATE,
    FACT_WEATHER,
    FACT_YIELD,
    FARM_FEED,
    STATION_FEED,
    shape,
)
from fieldlake.functions import parse_dates, upper_columns
from fieldlake.operators.dedup import first_per_key, latest_per_key
from fieldlake.operators.resolve import resolve_tiers


def clean_farms(feed: DataFrame, unique: bool = False) -> DataFrame:
    """One row per farm, places and crop in capitals, dates parsed. A `unique` feed has one row per key already."""
    rows = feed if unique else first_per_key(feed, FARM_FEED.key)
    return parse_dates(
        upper_columns(rows, ["state", "district", "crop"]), ["sowing_date", "harvesting_date"]
    )


def clean_stations(feed: DataFrame, unique: bool = False) -> DataFrame:
    """One row per station and day, places in capitals, date parsed."""
    rows = feed if unique else first_per_key(feed, STATION_FEED.key)
    return parse_dates(upper_columns(rows, ["state", "district"]), ["observation_date"])


def clean_climate(feed: DataFrame, unique: bool = False) -> DataFrame:
    """One row per observation, country and zone in capitals, date parsed."""
    rows = feed if unique else first_per_key(feed, CLIMATE_FEED.key)
    return parse_dates(upper_columns(rows, ["country", "climate_zone"]), ["date"])


def dim_farms(farms: DataFrame) -> DataFrame:
    return shape(farms, DIM_FARMS)


def dim_stations(stations: DataFrame) -> DataFrame:
    """One row per station over all its readings."""
    return first_per_key(shape(stations, DIM_STATIONS), DIM_STATIONS.key)


def yield_gap(expected: str, actual: str) -> Column:
    return F.col(expected) - F.col(actual)


def fact_crop_yield(matched: DataFrame) -> DataFrame:
    """One row per resolved farm; weather the farm reported itself gets its own names."""
    renamed = matched.withColumnsRenamed(
        {
            "rainfall_mm": "farm_reported_rainfall_mm",
            "avg_temperature_c": "farm_reported_avg_temp_c",
            "humidity_percent": "farm_reported_humidity_pct",
        }
    ).withColumn("yield_gap_tonnes", yield_gap("expected_yield_tonnes", "actual_yield_tonnes"))
    return shape(renamed, FACT_YIELD)


def fact_weather(stations: DataFrame) -> DataFrame:
    """The latest reading of each station."""
    return shape(
        latest_per_key(stations.select(*FACT_WEATHER.columns), FACT_WEATHER.key, "observation_date"),
        FACT_WEATHER,
    )


def fact_climate(climate: DataFrame) -> DataFrame:
    return shape(climate, FACT_CLIMATE)


def weather_of_known_stations(stations: DataFrame, dimension: DataFrame) -> DataFrame:
    """Every reading whose station is in the dimension."""
    return stations.join(dimension.select("station_code"), "station_code", "left_semi")


def match_farms(farms: DataFrame, stations: DataFrame, dimension: DataFrame) -> DataFrame:
    readings = stations.select("station_code", "state", "observation_date")
    return resolve_tiers(farms, dimension, readings)


def build_star(
    farms: DataFrame, stations: DataFrame, climate: DataFrame
) -> dict[str, DataFrame]:
    """The five published tables from the three clean tables."""
    dimension = dim_stations(stations)
    return {
        DIM_FARMS.name: dim_farms(farms),
        DIM_STATIONS.name: dimension,
        FACT_YIELD.name: fact_crop_yield(match_farms(farms, stations, dimension)),
        FACT_WEATHER.name: fact_weather(stations),
        FACT_CLIMATE.name: fact_climate(climate),
    }
