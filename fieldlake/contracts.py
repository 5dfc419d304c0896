"""Declared schemas of the raw feeds and of the published tables.

A contract is DDL text plus the table's key and layout. The text is read without
a Spark session, so that contracts also serve tools that have none.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    VarcharType,
)

# Widest decimal that Spark still keeps in one 64-bit long.
LAKE_PRECISION = 18


_TYPES = {
    "STRING": StringType,
    "DOUBLE": DoubleType,
    "INT": IntegerType,
    "BIGINT": LongType,
    "DATE": DateType,
    "VARCHAR": VarcharType,
    "DECIMAL": DecimalType,
}


def _field(text: str) -> StructField:
    """One column of a contract: `name TYPE`, `name TYPE(n)`, optionally NOT NULL."""
    name, declared, *rest = text.split(maxsplit=2)
    if rest not in ([], ["NOT NULL"]):
        raise ContractError(f"not understood in a contract: {text}")
    kind, *sizes = re.findall(r"\w+", declared)
    return StructField(name, _TYPES[kind](*map(int, sizes)), nullable=rest != ["NOT NULL"])


@dataclass(frozen=True)
class Contract:
    name: str
    ddl: str
    key: tuple[str, ...]
    partition_by: str | None = None
    bucket_by: str | None = None

    @cached_property
    def schema(self) -> StructType:
        return StructType([_field(text) for text in re.split(r",\s+", self.ddl.strip())])

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def required(self) -> list[str]:
        return [field.name for field in self.schema if not field.nullable]


class ContractError(ValueError):
    """A frame or a file does not have the columns its contract declares."""


# ---------------------------------------------------------------------------
# Names, order and types of the three raw feeds.
# ---------------------------------------------------------------------------

FARM_FEED = Contract(
    "feed_farms",
    """
    farm_id STRING NOT NULL, state STRING, district STRING, village STRING, crop STRING,
    crop_variety STRING, sowing_date STRING, harvesting_date STRING, season STRING,
    land_area_acres DOUBLE, soil_type STRING, soil_ph DOUBLE, nitrogen_kg_ha INT,
    phosphorus_kg_ha INT, potassium_kg_ha INT, fertilizer_used STRING, irrigation_method STRING,
    rainfall_mm DOUBLE, avg_temperature_c DOUBLE, humidity_percent INT, pest_attack STRING,
    disease_name STRING, pesticide_used STRING, expected_yield_tonnes DOUBLE,
    actual_yield_tonnes DOUBLE, water_consumption_litres DOUBLE, production_cost_inr DOUBLE,
    market_price_inr DOUBLE, profit_loss_inr DOUBLE, crop_health_score INT,
    sustainability_score INT
    """,
    key=("farm_id",),
)

STATION_FEED = Contract(
    "feed_stations",
    """
    station_code STRING NOT NULL, station_name STRING, state STRING, district STRING,
    observation_date STRING, season STRING, max_temp_c DOUBLE, min_temp_c DOUBLE,
    avg_temp_c DOUBLE, rainfall_mm DOUBLE, relative_humidity_percent INT, wind_speed_kmh DOUBLE,
    wind_direction STRING, visibility_km DOUBLE, cloud_cover_percent INT, sunshine_hours DOUBLE,
    atmospheric_pressure_hpa DOUBLE, soil_temperature_c DOUBLE, heat_index_c DOUBLE,
    dew_point_c DOUBLE, flood_warning STRING, cyclone_alert STRING, rainfall_category STRING,
    weather_condition STRING
    """,
    key=("station_code", "observation_date"),
)

CLIMATE_FEED = Contract(
    "feed_climate",
    """
    observation_id BIGINT NOT NULL, date STRING, station_id STRING, country STRING,
    latitude DOUBLE, longitude DOUBLE, elevation_m DOUBLE, avg_temperature_c DOUBLE,
    max_temperature_c DOUBLE, min_temperature_c DOUBLE, precipitation_mm DOUBLE,
    snowfall_cm DOUBLE, humidity_percent INT, wind_speed_kmh DOUBLE, wind_direction STRING,
    solar_radiation_wm2 DOUBLE, atmospheric_pressure_hpa DOUBLE, cloud_cover_percent INT,
    uv_index INT, soil_moisture_percent DOUBLE, drought_index STRING,
    evapotranspiration_mm DOUBLE, air_quality_index INT, pm25 DOUBLE, pm10 DOUBLE,
    co2_ppm DOUBLE, methane_ppb DOUBLE, ozone_ppb DOUBLE, climate_zone STRING,
    weather_event STRING, disaster_risk STRING
    """,
    key=("observation_id",),
)

# ---------------------------------------------------------------------------
# Names, order, types and nullability of the published tables.
# ---------------------------------------------------------------------------

DIM_FARMS = Contract(
    "dim_farms",
    """
    farm_id VARCHAR(20) NOT NULL, state VARCHAR(60) NOT NULL, district VARCHAR(60) NOT NULL,
    village VARCHAR(60) NOT NULL, crop VARCHAR(40) NOT NULL, crop_variety VARCHAR(40) NOT NULL,
    soil_type VARCHAR(30) NOT NULL, soil_ph DECIMAL(3,1) NOT NULL,
    land_area_acres DECIMAL(6,2) NOT NULL, irrigation_method VARCHAR(30) NOT NULL
    """,
    key=("farm_id",),
    bucket_by="farm_id",
)

DIM_STATIONS = Contract(
    "dim_weather_stations",
    """
    station_code VARCHAR(20) NOT NULL, station_name VARCHAR(80) NOT NULL,
    state VARCHAR(60) NOT NULL, district VARCHAR(60) NOT NULL
    """,
    key=("station_code",),
)

FACT_YIELD = Contract(
    "fact_crop_yield",
    """
    farm_id VARCHAR(20) NOT NULL, sowing_date DATE NOT NULL, harvesting_date DATE NOT NULL,
    season VARCHAR(10) NOT NULL, nitrogen_kg_ha INT NOT NULL, phosphorus_kg_ha INT NOT NULL,
    potassium_kg_ha INT NOT NULL, fertilizer_used VARCHAR(30) NOT NULL,
    farm_reported_rainfall_mm DECIMAL(6,2) NOT NULL,
    farm_reported_avg_temp_c DECIMAL(5,2) NOT NULL, farm_reported_humidity_pct INT NOT NULL,
    pest_attack VARCHAR(3) NOT NULL, disease_name VARCHAR(40), pesticide_used VARCHAR(30) NOT NULL,
    expected_yield_tonnes DECIMAL(8,2) NOT NULL, actual_yield_tonnes DECIMAL(8,2) NOT NULL,
    yield_gap_tonnes DECIMAL(8,2) NOT NULL, water_consumption_litres DECIMAL(12,2) NOT NULL,
    production_cost_inr DECIMAL(12,2) NOT NULL, market_price_inr DECIMAL(12,2) NOT NULL,
    profit_loss_inr DECIMAL(12,2) NOT NULL, crop_health_score DECIMAL(5,2) NOT NULL,
    sustainability_score DECIMAL(5,2) NOT NULL, matched_station_code VARCHAR(20),
    match_type VARCHAR(25) NOT NULL
    """,
    key=("farm_id",),
    partition_by="season",
    bucket_by="farm_id",
)

FACT_WEATHER = Contract(
    "fact_weather_observations",
    """
    station_code VARCHAR(20) NOT NULL, observation_date DATE NOT NULL,
    season VARCHAR(15) NOT NULL, max_temp_c DECIMAL(5,2) NOT NULL,
    min_temp_c DECIMAL(5,2) NOT NULL, avg_temp_c DECIMAL(5,2) NOT NULL,
    rainfall_mm DECIMAL(6,2) NOT NULL, relative_humidity_percent INT NOT NULL,
    wind_speed_kmh DECIMAL(5,2) NOT NULL, wind_direction VARCHAR(5) NOT NULL,
    visibility_km DECIMAL(5,2) NOT NULL, cloud_cover_percent INT NOT NULL,
    sunshine_hours DECIMAL(4,2) NOT NULL, atmospheric_pressure_hpa DECIMAL(6,2) NOT NULL,
    soil_temperature_c DECIMAL(5,2) NOT NULL, heat_index_c DECIMAL(5,2) NOT NULL,
    dew_point_c DECIMAL(5,2) NOT NULL, flood_warning VARCHAR(3) NOT NULL,
    cyclone_alert VARCHAR(3) NOT NULL, rainfall_category VARCHAR(15) NOT NULL,
    weather_condition VARCHAR(20) NOT NULL
    """,
    key=("station_code",),
    partition_by="season",
)

FACT_CLIMATE = Contract(
    "fact_global_climate_environment",
    """
    observation_id BIGINT NOT NULL, date DATE NOT NULL, station_id VARCHAR(20) NOT NULL,
    country VARCHAR(20) NOT NULL, latitude DECIMAL(9,6) NOT NULL,
    longitude DECIMAL(9,6) NOT NULL, elevation_m DECIMAL(7,2) NOT NULL,
    avg_temperature_c DECIMAL(5,2) NOT NULL, max_temperature_c DECIMAL(5,2) NOT NULL,
    min_temperature_c DECIMAL(5,2) NOT NULL, precipitation_mm DECIMAL(6,2) NOT NULL,
    snowfall_cm DECIMAL(6,2) NOT NULL, humidity_percent INT NOT NULL,
    wind_speed_kmh DECIMAL(5,2) NOT NULL, wind_direction VARCHAR(5) NOT NULL,
    solar_radiation_wm2 DECIMAL(6,2) NOT NULL, atmospheric_pressure_hpa DECIMAL(6,2) NOT NULL,
    cloud_cover_percent INT NOT NULL, uv_index INT NOT NULL,
    soil_moisture_percent DECIMAL(5,2) NOT NULL, drought_index VARCHAR(10) NOT NULL,
    evapotranspiration_mm DECIMAL(5,2) NOT NULL, air_quality_index INT NOT NULL,
    pm25 DECIMAL(5,2) NOT NULL, pm10 DECIMAL(5,2) NOT NULL, co2_ppm DECIMAL(6,2) NOT NULL,
    methane_ppb DECIMAL(7,2) NOT NULL, ozone_ppb DECIMAL(5,2) NOT NULL,
    climate_zone VARCHAR(15) NOT NULL, weather_event VARCHAR(15),
    disaster_risk VARCHAR(10) NOT NULL
    """,
    key=("observation_id",),
    partition_by="country",
)

ROLLUP_YIELD_WEATHER = Contract(
    "yield_weather_correlation",
    """
    correlation_id BIGINT NOT NULL, state VARCHAR(60) NOT NULL, crop VARCHAR(40) NOT NULL,
    rainfall_reporting_gap_pct DECIMAL(6,2) NOT NULL, avg_profit_loss_inr DECIMAL(12,2) NOT NULL,
    avg_yield_gap_tonnes DECIMAL(8,2) NOT NULL
    """,
    key=("state", "crop"),
)

ROLLUP_CLIMATE_RISK = Contract(
    "climate_risk_farms",
    """
    risk_id BIGINT NOT NULL, state VARCHAR(60) NOT NULL, crop VARCHAR(40) NOT NULL,
    exposure_flag VARCHAR(20) NOT NULL, pest_attack_rate_pct DECIMAL(5,2) NOT NULL,
    avg_crop_health_score DECIMAL(5,2) NOT NULL, avg_sustainability_score DECIMAL(5,2) NOT NULL
    """,
    key=("state", "crop", "exposure_flag"),
)

ROLLUP_ENVIRONMENT = Contract(
    "global_environment_summary",
    """
    summary_id BIGINT NOT NULL, country VARCHAR(20) NOT NULL, climate_zone VARCHAR(15) NOT NULL,
    avg_air_quality_index DECIMAL(6,2) NOT NULL, avg_co2_ppm DECIMAL(6,2) NOT NULL,
    avg_methane_ppb DECIMAL(7,2) NOT NULL, high_disaster_risk_pct DECIMAL(5,2) NOT NULL
    """,
    key=("country", "climate_zone"),
)

FEEDS = {c.name: c for c in (FARM_FEED, STATION_FEED, CLIMATE_FEED)}
STAR = {c.name: c for c in (DIM_FARMS, DIM_STATIONS, FACT_YIELD, FACT_WEATHER, FACT_CLIMATE)}
ROLLUPS = {c.name: c for c in (ROLLUP_YIELD_WEATHER, ROLLUP_CLIMATE_RISK, ROLLUP_ENVIRONMENT)}

# Dimensions before facts before rollups: the order in which keys resolve.
PUBLISH_ORDER = [*STAR, *ROLLUPS]


def lake_type(declared: DataType) -> DataType:
    """Type of a column inside the lake.

    Decimals keep their declared scale and take the widest long-backed
    precision, so one unusually large value never stops an analysis query;
    `conform` and `contract_violations` apply the declared precision.
    """
    if isinstance(declared, DecimalType):
        return DecimalType(LAKE_PRECISION, declared.scale)
    if isinstance(declared, VarcharType):
        return StringType()
    return declared


def require_columns(df: DataFrame, contract: Contract) -> None:
    missing = [name for name in contract.columns if name not in df.columns]
    if missing:
        raise ContractError(f"{contract.name}: missing columns {missing}")


def shape(df: DataFrame, contract: Contract) -> DataFrame:
    """Exactly the declared columns, in declared order, in lake types."""
    require_columns(df, contract)
    return df.select(
        *[F.col(f.name).cast(lake_type(f.dataType)).alias(f.name) for f in contract.schema]
    )


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """`shape` with the declared types enforced: a break raises at run time.

    Decimal overflow raises through the ANSI cast; over-long text and a null in
    a required column raise explicitly.
    """
    require_columns(df, contract)
    return df.select(*[_enforced(f, contract.name) for f in contract.schema])


def _enforced(field: StructField, table: str) -> Column:
    label = f"{table}.{field.name}"
    if isinstance(field.dataType, VarcharType):
        limit = field.dataType.length
        text = F.col(field.name).cast("string")
        value = F.when(
            F.length(text) > limit,
            F.raise_error(F.concat(F.lit(f"{label} exceeds {limit} characters: "), text)),
        ).otherwise(text)
    else:
        value = F.col(field.name).cast(field.dataType)
    if not field.nullable:
        value = F.coalesce(value, F.raise_error(F.lit(f"{label} is null")).cast(value_type(field)))
    return value.alias(field.name)


def value_type(field: StructField) -> DataType:
    return StringType() if isinstance(field.dataType, VarcharType) else field.dataType
