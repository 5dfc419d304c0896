"""The three raw feeds derived from the generic test tables.

The column expressions run unchanged on Spark and on other ANSI engines; names
and types come from the feed contracts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fieldlake.contracts import CLIMATE_FEED, FARM_FEED, STATION_FEED, Contract


@dataclass(frozen=True)
class Derived:
    """How one feed is computed: its rows, which of them come twice, its columns.

    `rows` names the tables in braces.
    """

    contract: Contract
    tables: tuple[str, ...]
    rows: str
    twice: str
    expressions: str

    def columns(self) -> dict[str, str]:
        pairs = (line.strip().split(" = ", 1) for line in self.expressions.strip().splitlines())
        return dict(pairs)


# ---------------------------------------------------------------------------
# The agreed column expressions of the test feeds.
# ---------------------------------------------------------------------------

FARMS = Derived(
    FARM_FEED,
    tables=('region', 'nation', 'customer', 'orders', 'lineitem'),
    rows="""
    from (select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate, o_totalprice,
                 cast(floor(o_totalprice*100+0.5) as bigint) as price_cents
          from {orders}) o
    join {customer} on o_custkey = c_custkey
    join {nation} on c_nationkey = n_nationkey
    join {region} on n_regionkey = r_regionkey
    left join (select l_orderkey, sum(l_quantity) as qty,
                      cast(sum(cast(floor(l_quantity*(1-l_discount)*100+0.5) as bigint)) as bigint)
                          as net_cents,
                      cast(sum(cast(floor(l_extendedprice*100+0.5) as bigint)) as bigint)
                          as cost_cents
               from {lineitem} group by l_orderkey) li on l_orderkey = o_orderkey
    """,
    twice="o_orderkey % 100 = 0",
    expressions="""
    farm_id = concat('F', o_orderkey)
    state = lower(r_name)
    district = lower(n_name)
    village = c_name
    crop = lower(c_mktsegment)
    crop_variety = o_orderpriority
    sowing_date = cast(cast(o_orderdate as date) as string)
    harvesting_date = cast(cast(cast(o_orderdate as date) + 120 as date) as string)
    season = case when month(o_orderdate) between 6 and 10 then 'Kharif' when month(o_orderdate) in (4,5) then 'Zaid' else 'Rabi' end
    land_area_acres = 1 + cast(o_orderkey % 400 as double)/10
    soil_type = o_orderstatus
    soil_ph = 4 + cast(o_orderkey % 110 as double)/10
    nitrogen_kg_ha = cast(o_orderkey % 120 as int)
    phosphorus_kg_ha = cast(o_orderkey % 60 as int)
    potassium_kg_ha = cast(o_orderkey % 80 as int)
    fertilizer_used = case when o_orderkey % 2 = 0 then 'Urea' else 'Compost' end
    irrigation_method = case when o_orderkey % 3 = 0 then 'Drip' else 'Canal' end
    rainfall_mm = cast(o_orderkey % 997 as double)/4
    avg_temperature_c = 10 + cast(o_orderkey % 300 as double)/10
    humidity_percent = cast(20 + o_orderkey % 75 as int)
    pest_attack = case when o_orderkey % 3 = 0 then 'Yes' else 'No' end
    disease_name = case when o_orderkey % 3 = 0 then 'Rust' end
    pesticide_used = case when o_orderkey % 3 = 0 then 'Neem' else 'None' end
    expected_yield_tonnes = coalesce(qty, 0)
    actual_yield_tonnes = cast(coalesce(net_cents, 0) as double)/100
    water_consumption_litres = cast(o_orderkey % 5000 as double)
    production_cost_inr = cast(coalesce(cost_cents, 0) as double)/100
    market_price_inr = o_totalprice
    profit_loss_inr = cast(price_cents - coalesce(cost_cents, 0) as double)/100
    crop_health_score = cast(case when o_orderkey % 3 = 0 then 30 + o_orderkey % 31 else 60 + o_orderkey % 37 end as int)
    sustainability_score = cast(40 + o_custkey % 60 as int)
    """,
)

STATIONS = Derived(
    STATION_FEED,
    tables=('region', 'nation', 'supplier', 'lineitem'),
    rows="""
    from {supplier}
    join {nation} on s_nationkey = n_nationkey
    join {region} on n_regionkey = r_regionkey
    join (select l_suppkey,
                 inline(array(struct(first_day as obs_date, 0 as which),
                              struct(last_day as obs_date, 1 as which)))
          from (select l_suppkey, cast(min(l_shipdate) as date) as first_day,
                       cast(max(l_shipdate) as date) as last_day
                from {lineitem} group by l_suppkey)) d on l_suppkey = s_suppkey
    where r_name <> 'MIDDLE EAST' and n_nationkey not in (3, 7, 15)
    """,
    twice="s_suppkey % 10 = 0",
    expressions="""
    station_code = concat('S', right(concat('000000', s_suppkey), 6))
    station_name = s_name
    state = lower(r_name)
    district = lower(n_name)
    observation_date = cast(obs_date as string)
    season = case when month(obs_date) in (12,1,2) then 'Winter' when month(obs_date) between 3 and 5 then 'Summer' when month(obs_date) between 6 and 9 then 'Monsoon' else 'Post-Monsoon' end
    max_temp_c = 30 + cast(s_suppkey % 15 as double)
    min_temp_c = 10 + cast(s_suppkey % 12 as double)
    avg_temp_c = 20 + cast(s_suppkey % 13 as double)
    rainfall_mm = cast(((s_suppkey * 13 + which * 7) % 25) * 10 as double)
    relative_humidity_percent = cast(30 + s_suppkey % 60 as int)
    wind_speed_kmh = cast(s_suppkey % 40 as double)
    wind_direction = case s_suppkey % 4 when 0 then 'N' when 1 then 'E' when 2 then 'S' else 'W' end
    visibility_km = 1 + cast(s_suppkey % 10 as double)
    cloud_cover_percent = cast(s_suppkey % 101 as int)
    sunshine_hours = cast(s_suppkey % 12 as double)
    atmospheric_pressure_hpa = 990 + cast(s_suppkey % 30 as double)
    soil_temperature_c = 15 + cast(s_suppkey % 15 as double)
    heat_index_c = 25 + cast(s_suppkey % 20 as double)
    dew_point_c = 5 + cast(s_suppkey % 15 as double)
    flood_warning = case when s_suppkey % 4 = 1 and r_name <> 'ASIA' then 'Yes' else 'No' end
    cyclone_alert = case when s_suppkey % 7 = 3 and r_name <> 'ASIA' then 'Yes' else 'No' end
    rainfall_category = case when s_suppkey % 3 = 0 then 'Light' else 'Heavy' end
    weather_condition = case when s_suppkey % 2 = 0 then 'Clear' else 'Cloudy' end
    """,
)

CLIMATE = Derived(
    CLIMATE_FEED,
    tables=('events',),
    rows="""
    from {events}
    """,
    twice="event_id % 100 = 0",
    expressions="""
    observation_id = event_id
    date = cast(cast(ts as date) as string)
    station_id = concat('G', user_id % 50)
    country = event_type
    latitude = 20 + cast(event_id % 500 as double)/10
    longitude = -60 - cast(event_id % 600 as double)/10
    elevation_m = cast(event_id % 3000 as double)
    avg_temperature_c = cast(event_id % 800 as double)/10 - 25
    max_temperature_c = cast(event_id % 800 as double)/10 - 20
    min_temperature_c = cast(event_id % 800 as double)/10 - 30
    precipitation_mm = cast((event_id * 7) % 1200 as double)/10
    snowfall_cm = cast(event_id % 30 as double)
    humidity_percent = cast(30 + floor(cast((event_id * 7) % 1200 as double)/20) as int)
    wind_speed_kmh = value
    wind_direction = case event_id % 4 when 0 then 'N' when 1 then 'E' when 2 then 'S' else 'W' end
    solar_radiation_wm2 = cast(event_id % 900 as double)
    atmospheric_pressure_hpa = 980 + cast(event_id % 50 as double)
    cloud_cover_percent = cast(event_id % 101 as int)
    uv_index = cast(event_id % 12 as int)
    soil_moisture_percent = 25 + floor(cast((event_id * 7) % 1200 as double)/60) + event_id % 5
    drought_index = case when (event_id * 7) % 1200 < 100 then 'High' when (event_id * 7) % 1200 < 400 then 'Medium' else 'Low' end
    evapotranspiration_mm = 3 + cast(event_id % 800 as double)/100 + event_id % 3
    air_quality_index = cast(160 - floor(cast((event_id * 7) % 1200 as double)/15) + event_id % 20 as int)
    pm25 = cast((event_id * 11) % 350 as double)/10
    pm10 = cast((event_id * 13) % 700 as double)/10
    co2_ppm = 400 + cast(event_id % 40 as double)
    methane_ppb = 1800 + cast(event_id % 150 as double)
    ozone_ppb = 20 + cast(event_id % 60 as double)
    climate_zone = case (event_id + user_id) % 4 when 0 then 'Polar' when 1 then 'Temperate' when 2 then 'Tropical' else 'Continental' end
    weather_event = case when event_id % 5 = 0 then 'Storm' end
    disaster_risk = case (event_id + user_id) % 3 when 0 then 'Low' when 1 then 'Medium' else 'High' end
    """,
)

DERIVED = {d.contract.name: d for d in (FARMS, STATIONS, CLIMATE)}


def derive_feed(spark: SparkSession, source_dir: str, name: str) -> DataFrame:
    """One feed as a lazy frame over the Parquet tables in `source_dir`."""
    feed = DERIVED[name]
    base = source_dir.rstrip("/")
    tables = {t: spark.read.parquet(f"{base}/{t}.parquet") for t in feed.tables}
    computed = feed.columns()
    fields = ",\n".join(
        f"cast({computed[f.name]} as {f.dataType.simpleString()}) as {f.name}"
        for f in feed.contract.schema
    )
    # A repeated row is copied in place; the joins above it run once.
    copies = f"explode(case when {feed.twice} then array(0, 1) else array(0) end)"
    text = f"select {fields}, {copies} as _copy {feed.rows}"
    return spark.sql(text, **tables).drop("_copy")
