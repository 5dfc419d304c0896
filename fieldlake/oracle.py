"""The same queries as plain SQL for an independent engine.

Every text is self-contained: common table expressions derive the feeds, the
clean tables and the star from the test tables, then the naive form of the
query follows (row numbers, NOT IN, joins of all candidates). Averages use
integer arithmetic, so no engine's decimal or rounding rules enter.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import combinations

from pyspark.sql.types import DateType, DecimalType, VarcharType

from fieldlake.contracts import (
    CLIMATE_FEED,
    DIM_FARMS,
    DIM_STATIONS,
    FACT_CLIMATE,
    FACT_WEATHER,
    FACT_YIELD,
    FARM_FEED,
    ROLLUPS,
    STAR,
    STATION_FEED,
    Contract,
)
from fieldlake.plans import charts
from fieldlake.sources.derived import CLIMATE, FARMS, STATIONS, Derived

# Integer arithmetic ----------------------------------------------------------


def rounded(total: str, n: str, scale: int, places: int) -> str:
    """total / 10^scale / n, half away from zero, for integer texts total and n."""
    unit, parts = 10**places, 10**scale
    return (
        f"cast(sign({total}) * ((2 * abs({total}) * {unit} + {parts} * ({n}))"
        f" // nullif(2 * {parts} * ({n}), 0)) as double) / {unit}"
    )


def avg(x: str, places: int = 2) -> str:
    """Rounded mean of values with two decimals."""
    return rounded(f"sum(cast(({x}) * 100 as bigint))", f"count({x})", 2, places)


def pct(k: str, n: str, places: int = 2) -> str:
    return rounded(f"(100 * cast({k} as hugeint))", n, 0, places)


def half_away(x: str, places: int = 2) -> str:
    return f"sign({x}) * floor(abs({x}) * {10**places} + 0.5) / {10**places}"


# Shared tables ---------------------------------------------------------------


def feed(derived: Derived, rows: str) -> str:
    computed = derived.columns()
    fields = ", ".join(
        f"cast({computed[f.name]} as {sql_type(f.dataType)}) as {f.name}"
        for f in derived.contract.schema
    )
    copy = f"{rows} {'and' if ' where ' in rows else 'where'} {derived.twice}"
    return f"select {fields} {rows} union all select {fields} {copy}"


def sql_type(data_type) -> str:
    if isinstance(data_type, VarcharType):
        return "varchar"
    if isinstance(data_type, DecimalType):
        return f"decimal(18,{data_type.scale})"
    return {"string": "varchar", "long": "bigint", "integer": "int"}.get(
        data_type.typeName(), data_type.typeName()
    )


def unique(contract: Contract, source: str, first: str = "", columns: Iterable[str] = ()) -> str:
    names = list(columns) or contract.columns
    rest = ", ".join(f"{c} asc nulls last" for c in names if c not in contract.key)
    return (
        f"select {', '.join(names)} from (select *, row_number() over (partition by"
        f" {', '.join(contract.key)} order by {first}{rest}) as rn from {source}) where rn = 1"
    )


def cleaned(contract: Contract, source: str, upper: list[str], dates: list[str]) -> str:
    def expr(c: str) -> str:
        if c in upper:
            return f"upper({c}) as {c}"
        return f"try_cast({c} as date) as {c}" if c in dates else c

    return f"select {', '.join(expr(c) for c in contract.columns)} from {source}"


def shaped(contract: Contract, source: str) -> str:
    fields = ", ".join(f"cast({f.name} as {sql_type(f.dataType)}) as {f.name}" for f in contract.schema)
    return f"select {fields} from {source}"


def plain(contract: Contract, source: str) -> str:
    """All columns with decimals as doubles and dates as text."""
    def expr(f) -> str:
        if isinstance(f.dataType, DecimalType):
            return f"cast({f.name} as double) as {f.name}"
        if isinstance(f.dataType, DateType):
            return f"cast({f.name} as varchar) as {f.name}"
        return f.name

    return f"select {', '.join(expr(f) for f in contract.schema)} from {source}"


_FARM_ROWS = """
 from (select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate, o_totalprice,
   cast(floor(o_totalprice*100+0.5) as bigint) as price_cents from orders) o
 join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
 join region on n_regionkey = r_regionkey
 left join (select l_orderkey, sum(l_quantity) as qty,
   cast(sum(cast(floor(l_quantity*(1-l_discount)*100+0.5) as bigint)) as bigint) as net_cents,
   cast(sum(cast(floor(l_extendedprice*100+0.5) as bigint)) as bigint) as cost_cents
   from lineitem group by l_orderkey) li on l_orderkey = o_orderkey"""
_STATION_ROWS = """
 from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
 join (select l_suppkey, cast(min(l_shipdate) as date) as obs_date, 0 as which
   from lineitem group by l_suppkey
   union select l_suppkey, cast(max(l_shipdate) as date), 1 from lineitem group by l_suppkey) d
   on l_suppkey = s_suppkey
 where r_name <> 'MIDDLE EAST' and n_nationkey not in (3, 7, 15)"""

_ALERT = "(upper(flood_warning) = 'YES' or upper(cyclone_alert) = 'YES')"

_FACT_YIELD_SOURCE = """(select * replace (expected_yield_tonnes as expected_yield_tonnes),
   rainfall_mm as farm_reported_rainfall_mm, avg_temperature_c as farm_reported_avg_temp_c,
   humidity_percent as farm_reported_humidity_pct,
   expected_yield_tonnes - actual_yield_tonnes as yield_gap_tonnes from matched)"""


def shared_tables() -> dict[str, str]:
    return {
        "feed_farms": feed(FARMS, _FARM_ROWS),
        "feed_stations": feed(STATIONS, _STATION_ROWS),
        "feed_climate": feed(CLIMATE, " from events"),
        "unique_farms": unique(FARM_FEED, "feed_farms"),
        "unique_stations": unique(STATION_FEED, "feed_stations"),
        "unique_climate": unique(CLIMATE_FEED, "feed_climate"),
        "farms": cleaned(
            FARM_FEED, "unique_farms", ["state", "district", "crop"], ["sowing_date", "harvesting_date"]
        ),
        "stations": cleaned(
            STATION_FEED, "unique_stations", ["state", "district"], ["observation_date"]
        ),
        "climate": cleaned(CLIMATE_FEED, "unique_climate", ["country", "climate_zone"], ["date"]),
        "dim_f": shaped(DIM_FARMS, "farms"),
        "dim_s": unique(DIM_STATIONS, "stations"),
        "exact_match": """select farm_id, station_code as matched_station_code from (
            select f.farm_id, s.station_code,
                   row_number() over (partition by f.farm_id order by s.station_code) as rn
            from farms f join dim_s s on f.state = s.state and f.district = s.district)
            where rn = 1""",
        "no_exact": """select * from farms f where not exists (
            select 1 from dim_s s where f.state = s.state and f.district = s.district)""",
        "nearest_match": """select farm_id, station_code as matched_station_code from (
            select f.farm_id, r.station_code, row_number() over (partition by f.farm_id order by
                   abs(date_diff('day', r.observation_date, f.sowing_date)) asc nulls last,
                   r.station_code) as rn
            from no_exact f join stations r on f.state = r.state) where rn = 1""",
        "matched": """select f.*,
            coalesce(e.matched_station_code, n.matched_station_code) as matched_station_code,
            case when e.farm_id is not null then 'Exact District Match'
                 when n.farm_id is not null then 'Nearest In State'
                 else 'Unresolved' end as match_type
            from farms f left join exact_match e on f.farm_id = e.farm_id
            left join nearest_match n on f.farm_id = n.farm_id""",
        "fact_y": shaped(FACT_YIELD, _FACT_YIELD_SOURCE),
        "fact_w": shaped(
            FACT_WEATHER,
            "("
            + unique(
                FACT_WEATHER,
                "stations",
                first="observation_date desc nulls last, ",
                columns=FACT_WEATHER.columns,
            )
            + ")",
        ),
        "fact_c": shaped(FACT_CLIMATE, "climate"),
        "farm_yield": """select y.*, d.state, d.district, d.crop, d.crop_variety, d.land_area_acres
            from fact_y y join dim_f d on y.farm_id = d.farm_id""",
        "joined": """select y.*, w.rainfall_mm, w.season as season_station, w.flood_warning,
            w.cyclone_alert
            from farm_yield y join fact_w w on y.matched_station_code = w.station_code""",
        "roll_yw": f"""select state, crop,
            {half_away("(cast(sum(farm_reported_rainfall_mm - rainfall_mm) as double)"
                       " / cast(count(farm_reported_rainfall_mm - rainfall_mm) as double))"
                       " / nullif(cast(sum(rainfall_mm) as double)"
                       " / cast(count(rainfall_mm) as double), 0) * 100")}
                as rainfall_reporting_gap_pct,
            {avg("profit_loss_inr")} as avg_profit_loss_inr,
            {avg("yield_gap_tonnes")} as avg_yield_gap_tonnes
            from joined group by state, crop""",
        "roll_cr": f"""select state, crop,
            case when {_ALERT} then 'Flood/Cyclone Alert' else 'No Alert' end as exposure_flag,
            {pct("count(*) filter (upper(pest_attack) = 'YES')", "count(*)")}
                as pest_attack_rate_pct,
            {avg("crop_health_score")} as avg_crop_health_score,
            {avg("sustainability_score")} as avg_sustainability_score
            from joined group by all""",
        "roll_env": f"""select country, climate_zone,
            {avg("air_quality_index")} as avg_air_quality_index, {avg("co2_ppm")} as avg_co2_ppm,
            {avg("methane_ppb")} as avg_methane_ppb,
            {pct("count(*) filter (upper(disaster_risk) = 'HIGH')", "count(*)")}
                as high_disaster_risk_pct
            from fact_c group by all""",
    }


# Query bodies ----------------------------------------------------------------


def trend(column: str, condition: str = "true") -> dict[str, str]:
    steps = [i / 5 for i in range(6)]
    picks = ", ".join(
        f"max(x) filter (rk = floor({p:.1f}::double * (n - 1))) as lo{i},"
        f" max(x) filter (rk = ceil({p:.1f}::double * (n - 1))) as hi{i}"
        for i, p in enumerate(steps)
    )
    edges = ", ".join(
        f"lo{i} + (hi{i} - lo{i}) * ({p:.1f}::double * (n - 1) - floor({p:.1f}::double * (n - 1)))"
        for i, p in enumerate(steps)
    )
    return {
        "points": f"""select crop, cast({column} as double) as x, profit_loss_inr,
            row_number() over (partition by crop order by {column}) - 1 as rk,
            count(*) over (partition by crop) as n
            from joined where {column} is not null and {condition}""",
        "picked": f"select crop, n, {picks} from points group by crop, n",
        "edges": f"select crop, unnest([{edges}]) as edge from picked",
        "edge": """select crop, edge, row_number() over (partition by crop order by edge) as pos
            from (select distinct crop, edge from edges)""",
        "binned": """select p.crop, p.profit_loss_inr, greatest(
              (select count(*) from edge e where e.crop = p.crop and e.edge < p.x), 1) as bin
            from points p""",
        "": f"""select b.crop, cast(b.bin as int) as bin, round(max(lo.edge), 6) as low,
            round(max(coalesce(hi.edge, lo.edge)), 6) as high,
            round((max(lo.edge) + max(coalesce(hi.edge, lo.edge))) / 2, 6) as midpoint,
            count(*) as rows_in_bin, {avg("b.profit_loss_inr")} as avg_profit_loss_inr
            from binned b join edge lo on lo.crop = b.crop and lo.pos = b.bin
            left join edge hi on hi.crop = b.crop and hi.pos = b.bin + 1
            group by b.crop, b.bin""",
    }


def fixed_bins(column: str, edges: list, labels: list[str], value: str, label: str) -> str:
    parts = [
        f"select {i} as position, '{name}' as {label}, (select {avg(value)} from fact_c"
        f" where {column} > {low} and {column} <= {high}) as {value}"
        for i, (low, high, name) in enumerate(zip(edges, edges[1:], labels), start=1)
    ]
    return " union all ".join(parts)


def corr_rows(pairs: Iterable[tuple[str, str]], table: str) -> str:
    return " union all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr(cast({a} as double), cast({b} as double)), 6)"
        f" as r from {table}"
        for a, b in pairs
    )


def check(check_id: str, violations: str, observed: str, source: str = "") -> str:
    return (
        f"select '{check_id}' as check_id, violations, observed, violations = 0 as passed from"
        f" (select cast({violations} as bigint) as violations,"
        f" cast({observed} as bigint) as observed {source})"
    )


def violations_of(contract: Contract, table: str) -> str:
    def row(f) -> str:
        long = out = nulls = "0"
        if not f.nullable:
            nulls = f"count(*) filter ({f.name} is null)"
        if isinstance(f.dataType, VarcharType):
            long = f"count(*) filter (length({f.name}) > {f.dataType.length})"
        if isinstance(f.dataType, DecimalType):
            limit = 10 ** (f.dataType.precision - f.dataType.scale)
            out = f"count(*) filter (abs({f.name}) >= {limit})"
        return (
            f"select '{contract.name}' as table_name, '{f.name}' as column_name,"
            f" cast({nulls} as bigint) as nulls, cast({long} as bigint) as too_long,"
            f" cast({out} as bigint) as out_of_range from {table}"
        )

    return " union all ".join(row(f) for f in contract.schema)


def contrast_row(value: str) -> str:
    with_pest = f"(select {avg(value)} from fact_y where upper(pest_attack) = 'YES')"
    without = f"(select {avg(value)} from fact_y where upper(pest_attack) = 'NO')"
    return (
        f"select measure, mean_without, mean_with, round(mean_with - mean_without, 2) as difference,"
        f" round(100 * (mean_with - mean_without) / nullif(abs(mean_without), 0), 2) as change_pct"
        f" from (select '{value}' as measure, {without} as mean_without, {with_pest} as mean_with)"
    )


_CHECKS = {
    "dq_unique_keys": check(
        "unique_keys",
        " + ".join(
            f"(select count(*) - count(distinct {k}) from {t})"
            for t, k in [
                ("dim_f", "farm_id"),
                ("dim_s", "station_code"),
                ("fact_y", "farm_id"),
                ("fact_w", "station_code"),
                ("fact_c", "observation_id"),
            ]
        ),
        " + ".join(
            f"(select count(*) from {t})" for t in ("dim_f", "dim_s", "fact_y", "fact_w", "fact_c")
        ),
    ),
    "dq_fallback_places": check(
        "fallback_places",
        "count(*) filter (match_type = 'Exact District Match')",
        "count(*)",
        "from farm_yield y where not exists (select 1 from dim_s s"
        " where s.state = y.state and s.district = y.district)",
    ),
    "dq_unresolved": check(
        "unresolved_farms",
        "count(*) filter ((matched_station_code is null) <> (match_type = 'Unresolved'))",
        "count(*) filter (matched_station_code is null)",
        "from fact_y",
    ),
    "dq_vocab_overlap": check(
        "season_words",
        "(select count(*) from (select season from fact_y intersect select season from fact_w))",
        "(select count(*) from (select distinct season from fact_y))",
    ),
    "dq_station_ids": check(
        "unstable_station_ids",
        "0",
        "count(*)",
        """from (select station_id from fact_c group by station_id
                 having count(distinct country) > 1 or count(distinct climate_zone) > 1
                 or count(distinct latitude) > 1 or count(distinct longitude) > 1)""",
    ),
    "dq_profit_rows": check(
        "profit_rows",
        "abs((select count(*) from farms where profit_loss_inr >= 0)"
        " - (select count(*) from fact_y where profit_loss_inr >= 0))",
        "(select count(*) from fact_y where profit_loss_inr >= 0)",
    ),
    "dq_ph_range": check(
        "soil_ph_range",
        "count(*) filter (soil_ph < 0 or soil_ph > 14)",
        "count(soil_ph)",
        "from dim_f",
    ),
    "dq_large_gap": check(
        "rainfall_gap_over_20_pct",
        "0",
        """count(*) filter (case when rainfall_mm = 0 then farm_reported_rainfall_mm <> 0
             else abs(farm_reported_rainfall_mm - rainfall_mm) * 100 > 20 * abs(rainfall_mm) end)""",
        "from joined",
    ),
    "dq_orphans": check(
        "orphans",
        "(select count(*) from fact_y where matched_station_code is not null and"
        " matched_station_code not in (select station_code from dim_s))"
        " + (select count(*) from fact_y where farm_id not in (select farm_id from dim_f))"
        " + (select count(*) from fact_w where station_code not in (select station_code from dim_s))",
        "(select count(matched_station_code) from fact_y)",
    ),
    "dq_row_counts": check(
        "row_counts",
        "abs((select count(*) from farms) - (select count(*) from fact_y))"
        " + abs((select count(*) from farms) - (select count(*) from dim_f))",
        "(select count(*) from farms)",
    ),
}


def _counts(tables: dict[str, str], name: str) -> str:
    return " union all ".join(
        f"select '{label}' as {name}, count(*) as rows from {table}" for label, table in tables.items()
    )


_RUNNING = rounded(
    "sum(cast(profit_loss_inr * 100 as bigint)) over w", "count(profit_loss_inr) over w", 2, 2
)
_OFF_PERCENT = """case when rainfall_mm <> 0 then
   (2 * abs(cast((farm_reported_rainfall_mm - rainfall_mm) * 100 as hugeint)) * 10000000000
    + cast(rainfall_mm * 100 as hugeint)) // (2 * cast(rainfall_mm * 100 as hugeint)) end"""


def bodies() -> dict[str, str | dict[str, str]]:
    """The final SELECT of each query, or its extra tables with the SELECT under ''."""
    matched_cols = "farm_id, state, district, cast(sowing_date as varchar) as sowing_date"
    drawn = "select * from fact_y order by md5(farm_id || ':42'), farm_id limit 200"
    return {
        "ingest_row_counts": _counts(
            {t: t for t in ("feed_farms", "feed_stations", "feed_climate")}, "feed"
        ),
        "dedup_by_key": "select * from unique_farms",
        "dedup_composite_key": """select * exclude (rn) replace (cast(l_shipdate as varchar) as l_shipdate)
            from (select *, row_number() over (partition by l_orderkey, l_linenumber order by
              l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
              l_linestatus, l_shipdate) as rn
              from (select * replace (cast(l_shipdate as date) as l_shipdate) from lineitem))
            where rn = 1""",
        "standardize_text": """select farm_id, upper(state) as state, upper(district) as district,
            upper(crop) as crop from feed_farms""",
        "parse_dates": """select farm_id,
            cast(try_cast(sowing_date as date) as varchar) as sowing_date,
            cast(try_cast(harvesting_date as date) as varchar) as harvesting_date,
            cast(try_cast(season as date) as varchar) as season from feed_farms""",
        "clean_farms": """select * replace (cast(sowing_date as varchar) as sowing_date,
            cast(harvesting_date as varchar) as harvesting_date) from farms""",
        "clean_stations": """select * replace (cast(observation_date as varchar)
            as observation_date) from stations""",
        "clean_climate": "select * replace (cast(date as varchar) as date) from climate",
        "dim_farms": plain(DIM_FARMS, "dim_f"),
        "dim_stations": plain(DIM_STATIONS, "dim_s"),
        "latest_per_station": plain(FACT_WEATHER, "fact_w"),
        "weather_for_known_stations": """select * replace (cast(observation_date as varchar)
            as observation_date) from stations
            where station_code in (select station_code from dim_s)""",
        "match_exact": """select f.farm_id, f.state, f.district, e.matched_station_code
            from farms f join exact_match e on f.farm_id = e.farm_id""",
        "match_unmatched": "select farm_id, state, district from no_exact",
        "unmatched_places": "select distinct state, district from no_exact",
        "match_nearest_in_group": """select f.farm_id, f.state,
            cast(f.sowing_date as varchar) as sowing_date, n.matched_station_code
            from farms f join nearest_match n on f.farm_id = n.farm_id""",
        "match_two_tier": f"select {matched_cols}, matched_station_code, match_type from matched",
        "match_type_counts": "select match_type, count(*) as farms from fact_y group by match_type",
        "fact_crop_yield": plain(FACT_YIELD, "fact_y"),
        "fact_global_climate_environment": plain(FACT_CLIMATE, "fact_c"),
        "yield_gap": """select farm_id, cast(expected_yield_tonnes as double)
              as expected_yield_tonnes, cast(actual_yield_tonnes as double) as actual_yield_tonnes,
            cast(expected_yield_tonnes - actual_yield_tonnes as double) as yield_gap_tonnes
            from fact_y""",
        "conform_yield_contract": plain(FACT_YIELD, "fact_y"),
        "farm_weather_join": """select farm_id, state, crop,
            cast(rainfall_mm as double) as rainfall_mm,
            cast(farm_reported_rainfall_mm as double) as farm_reported_rainfall_mm,
            cast(profit_loss_inr as double) as profit_loss_inr, season, season_station from joined""",
        "avg_profit_by_state_crop": f"""select state, crop,
            {avg("profit_loss_inr")} as avg_profit_loss_inr, count(*) as total_farms
            from farm_yield group by state, crop""",
        "avg_profit_by_state": f"""select state, {avg("profit_loss_inr")} as avg_profit_loss_inr,
            count(*) as farm_count from farm_yield group by state""",
        "top10_yield_gap": """select farm_id, state, district, crop,
            cast(expected_yield_tonnes as double) as expected_yield_tonnes,
            cast(actual_yield_tonnes as double) as actual_yield_tonnes,
            cast(yield_gap_tonnes as double) as yield_gap_tonnes
            from farm_yield f order by f.yield_gap_tonnes desc nulls last, farm_id limit 10""",
        "rainfall_gap_by_state": f"""select state,
            {avg("farm_reported_rainfall_mm")} as avg_farm_reported_rainfall_mm,
            {avg("rainfall_mm")} as avg_station_reported_rainfall_mm,
            {avg("farm_reported_rainfall_mm - rainfall_mm")} as avg_absolute_gap_mm,
            {rounded("sum(off)", "count(off)", 8, 2)} as avg_gap_percentage
            from (select *, cast({_OFF_PERCENT} as bigint) as off from joined) group by state""",
        "rank_crops": f"""select *, cast(rank() over (partition by state
              order by avg_sustainability_score desc nulls last) as int) as sustainability_rank
            from (select state, crop, {avg("sustainability_score")} as avg_sustainability_score
                  from farm_yield group by state, crop)""",
        "best_crop_per_state": f"""select state, crop, round(avg_score, 6) as avg_score, crop_rank
            from (select *, cast(rank() over (partition by state order by avg_score desc nulls last)
                as int) as crop_rank
              from (select state, crop, {avg("sustainability_score", 10)} as avg_score
                    from farm_yield group by state, crop)) where crop_rank = 1""",
        "compare_match_types": f"""select match_type, {avg("profit_loss_inr")}
              as avg_profit_loss_inr,
            {avg("expected_yield_tonnes - actual_yield_tonnes")} as avg_yield_gap_tonnes,
            count(*) as farm_count from fact_y group by match_type""",
        "running_avg_profit": f"""select farm_id, cast(sowing_date as varchar) as sowing_date,
            cast(profit_loss_inr as double) as profit_loss_inr,
            {_RUNNING} as running_avg_profit_loss_inr
            from fact_y window w as (order by fact_y.sowing_date nulls first, farm_id nulls first
              rows between unbounded preceding and current row)""",
        "states_without_alerts": f"""select distinct state from dim_f where state not in (
            select state from joined where {_ALERT})""",
        "pest_vs_health": f"""select pest_attack, {avg("crop_health_score")}
              as avg_crop_health_score, {avg("sustainability_score")} as avg_sustainability_score,
            count(*) as farm_count from fact_y group by pest_attack""",
        "disaster_risk_share": f"""select g.country, g.disaster_risk,
            count(*) as risk_occurrence_count, {pct("count(*)", "max(t.n)")} as risk_percentage
            from fact_c g join (select country, count(*) as n from fact_c group by country) t
            on g.country = t.country group by g.country, g.disaster_risk""",
        "highest_yield_crop": f"""select state, crop, avg_actual_yield_tonnes from (
            select *, dense_rank() over (partition by state
              order by avg_actual_yield_tonnes desc nulls last) as r
            from (select state, crop, {avg("actual_yield_tonnes")} as avg_actual_yield_tonnes
                  from farm_yield group by state, crop)) where r = 1""",
        "rollup_yield_weather": "select * from roll_yw",
        "rollup_climate_risk": "select * from roll_cr",
        "rollup_environment": "select * from roll_env",
        "rollup_surrogate_key": """select row_number() over (order by state, crop, exposure_flag)
            as risk_id, state, crop, exposure_flag from roll_cr""",
        "overview_kpis": f"""select count(*) as total_farms,
            (select count(distinct crop_variety) from dim_f) as crop_varieties,
            {pct("count(*) filter (profit_loss_inr < 0)", "count(*)", 1)} as loss_pct,
            count(distinct matched_station_code) as stations_matched from fact_y""",
        "profit_split": """select count(*) filter (profit_loss_inr < 0) as loss_farms,
            count(*) filter (profit_loss_inr >= 0) as profit_farms from fact_y""",
        "preview_farm_yield": """select farm_id, state, crop, season,
            cast(profit_loss_inr as double) as profit_loss_inr, match_type
            from farm_yield order by farm_id limit 5""",
        "preview_stations": "select * from dim_s order by station_code limit 5",
        "preview_climate": """select observation_id, cast(date as varchar) as date, country,
            air_quality_index from fact_c order by observation_id limit 5""",
        "yield_axis_max": """select cast(greatest(max(expected_yield_tonnes),
            max(actual_yield_tonnes)) as double) as axis_max from fact_y""",
        "sample_yields": f"select farm_id, season, cast(expected_yield_tonnes as double) as expected_yield_tonnes,"
        f" cast(actual_yield_tonnes as double) as actual_yield_tonnes from ({drawn})",
        "sample_axis_max": f"""select cast(greatest(max(expected_yield_tonnes),
            max(actual_yield_tonnes)) as double) as axis_max from ({drawn})""",
        "distinct_crops": "select distinct crop from dim_f",
        "default_crops": "select distinct crop from dim_f order by crop limit 4",
        "rainfall_gap_signed": f"""select state,
            {avg("farm_reported_rainfall_mm - rainfall_mm")} as rainfall_gap_mm
            from joined group by state""",
        "profit_trend_by_bin": trend(
            "production_cost_inr",
            "crop in (select distinct crop from dim_f order by crop limit 4)",
        ),
        "profit_trend_by_rainfall": trend("rainfall_mm"),
        "profit_trend_by_land_area": trend("land_area_acres"),
        "pivot_crop_health": f"""select crop, state, {avg("crop_health_score")} as crop_health_score
            from farm_yield group by crop, state""",
        "pest_rate_by_alert": f"""select has_alert, yes as pest_yes, nope as pest_no,
            {pct("yes", "(yes + nope)")} as pest_attack_rate_pct
            from (select case when {_ALERT} then 'Alert Triggered' else 'No Alert' end as has_alert,
                  count(*) filter (upper(pest_attack) = 'YES') as yes,
                  count(*) filter (upper(pest_attack) = 'NO') as nope
                  from joined group by all)""",
        "pest_impact": f"""select pest_attack, {avg("crop_health_score")} as crop_health_score,
            {avg("yield_gap_tonnes")} as yield_gap_tonnes from fact_y group by pest_attack""",
        "pest_contrast": " union all ".join(
            contrast_row(v)
            for v in ("crop_health_score", "yield_gap_tonnes", "actual_yield_tonnes")
        ),
        "aqi_by_country": f"""select country, {avg("air_quality_index")} as air_quality_index
            from fact_c group by country""",
        "risk_crosstab_pct": f"""select climate_zone, disaster_risk, n as rows,
            {pct("n", "sum(n) over (partition by climate_zone)")} as percent
            from (select climate_zone, disaster_risk, count(*) as n from fact_c
                  where disaster_risk is not null group by all)""",
        "drought_profile": " union all ".join(
            f"select {i} as position, '{name}' as drought_index,"
            f" (select {avg('soil_moisture_percent')} from fact_c where drought_index = '{name}')"
            " as soil_moisture_percent,"
            f" (select {avg('precipitation_mm')} from fact_c where drought_index = '{name}')"
            " as precipitation_mm"
            for i, name in enumerate(charts.DROUGHT_ORDER, start=1)
        ),
        "bin_temp_evapo": fixed_bins(
            "avg_temperature_c",
            charts.TEMPERATURE_EDGES,
            charts.TEMPERATURE_LABELS,
            "evapotranspiration_mm",
            "temp_range",
        ),
        "bin_precip_aqi": fixed_bins(
            "precipitation_mm",
            charts.RAIN_EDGES,
            charts.RAIN_LABELS,
            "air_quality_index",
            "precip_range",
        ),
        "correlation_matrix": corr_rows(
            [(b, a) for a, b in combinations(charts.ENVIRONMENT_MEASURES, 2)], "fact_c"
        ),
        "named_correlations": " union all ".join(
            [
                corr_rows([("rainfall_mm", "profit_loss_inr")], "joined"),
                corr_rows(
                    [
                        ("production_cost_inr", "profit_loss_inr"),
                        ("crop_health_score", "yield_gap_tonnes"),
                        ("expected_yield_tonnes", "actual_yield_tonnes"),
                    ],
                    "fact_y",
                ),
                corr_rows(
                    [
                        ("avg_temperature_c", "evapotranspiration_mm"),
                        ("precipitation_mm", "air_quality_index"),
                    ],
                    "fact_c",
                ),
            ]
        ),
        "profit_identity_residual": """select max(abs(profit_loss_inr -
            (market_price_inr - production_cost_inr))) as max_residual from farms""",
        "median_margin": {
            "margins": """select m, row_number() over (order by m) - 1 as rk, count(*) over () as n
                from (select cast(profit_loss_inr as double)
                      / nullif(cast(market_price_inr as double), 0) * 100 as m from fact_y)
                where m is not null""",
            "": """select round(max(m) filter (rk = floor(0.5::double * (n - 1)))
                + (max(m) filter (rk = ceil(0.5::double * (n - 1)))
                   - max(m) filter (rk = floor(0.5::double * (n - 1))))
                * (0.5::double * (max(n) - 1) - floor(0.5::double * (max(n) - 1))), 6)
                as median_margin_pct from margins""",
        },
        "unstable_ids": """select *, greatest(country_values, climate_zone_values, latitude_values,
              longitude_values) > 1 as unstable
            from (select station_id, count(distinct country) as country_values,
              count(distinct climate_zone) as climate_zone_values,
              count(distinct latitude) as latitude_values,
              count(distinct longitude) as longitude_values from fact_c group by station_id)""",
        "stage_row_counts": _counts(
            {
                "feed_farms": "feed_farms",
                "clean_farms": "farms",
                "feed_stations": "feed_stations",
                "clean_stations": "stations",
                "feed_climate": "feed_climate",
                "dim_farms": "dim_f",
                "dim_weather_stations": "dim_s",
                "fact_crop_yield": "fact_y",
                "fact_weather_observations": "fact_w",
                "fact_global_climate_environment": "fact_c",
            },
            "table_name",
        ),
        "dq_duplicate_keys": " union all ".join(
            f"select '{name}' as table_name, count(*) as rows, count(distinct {key}) as keys,"
            f" count(*) - count(distinct {key}) as duplicates from {table}"
            for name, table, key in [
                ("dim_farms", "dim_f", "farm_id"),
                ("dim_weather_stations", "dim_s", "station_code"),
                ("fact_crop_yield", "fact_y", "farm_id"),
                ("fact_weather_observations", "fact_w", "station_code"),
                ("fact_global_climate_environment", "fact_c", "observation_id"),
            ]
        ),
        **_CHECKS,
        "dq_summary": "select count(*) as executed, count(*) filter (passed) as passed,"
        " count(*) filter (not passed) as failed from ("
        + " union all ".join(_CHECKS.values())
        + ")",
        "contract_violations": {
            "num_yw": "select row_number() over (order by state, crop) as correlation_id, *"
            " from roll_yw",
            "num_cr": "select row_number() over (order by state, crop, exposure_flag) as risk_id, *"
            " from roll_cr",
            "num_env": "select row_number() over (order by country, climate_zone) as summary_id, *"
            " from roll_env",
            "": " union all ".join(
                violations_of(contract, table)
                for contract, table in zip(
                    [*STAR.values(), *ROLLUPS.values()],
                    ["dim_f", "dim_s", "fact_y", "fact_w", "fact_c", "num_yw", "num_cr", "num_env"],
                )
            ),
        },
    }


def compose(body: str | dict[str, str], shared: dict[str, str]) -> str:
    """WITH the shared and own tables that the body needs, in definition order."""
    own = {} if isinstance(body, str) else {k: v for k, v in body.items() if k}
    final = body if isinstance(body, str) else body[""]
    tables = {**shared, **own}
    needed: set[str] = set()
    pending = [final]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & tables.keys() - needed:
            needed.add(name)
            pending.append(tables[name])
    defined = [f"{name} as materialized ({tables[name]})" for name in tables if name in needed]
    return f"with {', '.join(defined)} {final}" if defined else final


def oracle_sql() -> dict[str, str]:
    shared = shared_tables()
    return {name: compose(body, shared) for name, body in bodies().items()}
