import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from fieldlake.contracts import ROLLUPS, STAR
from fieldlake.plans import checks, quality
from fieldlake.plans.lake import Lake


@pytest.fixture
def lake(spark, small_dir):
    return Lake.of(spark, small_dir)


def few(df, key, n):
    return df.orderBy(key).limit(n)


def same(star, farms):
    one_by_one = quality.run_checks(star, quality.standard_checks(farms))
    compiled = checks.run_standard(star, farms)
    assert compiled.dtypes == one_by_one.dtypes
    found = rows(compiled)
    assert found == rows(one_by_one)
    return {r[0]: r for r in found}


def test_compiled_checks_are_the_single_checks(lake):
    found = same(lake.star(), lake.farms)
    assert [r.check_id for r in checks.run_standard(lake.star(), lake.farms).collect()] == [r.check_id for r in checks.STANDARD]
    assert len(found) == 10 and sum(not r[3] for r in found.values()) == 1


def test_faults_are_counted_alike(lake):
    star = dict(lake.star())
    facts, stations = star["fact_crop_yield"], star["dim_weather_stations"]
    some = F.pmod(F.xxhash64("farm_id"), F.lit(7))
    star["fact_crop_yield"] = (
        facts.withColumn("matched_station_code", F.when(some == 1, "gone").when(some != 2, F.col("matched_station_code")))
        .withColumn("match_type", F.when(some == 3, "Exact District Match").when(some != 4, F.col("match_type")))
        .withColumn("farm_id", F.when(some == 5, "nobody").when(some != 6, F.col("farm_id")))
        .withColumn("season", F.when(some == 0, "Winter").otherwise(F.col("season")))
        .unionByName(few(facts, 'farm_id', 11))
    )
    farms = star["dim_farms"]
    star["dim_farms"] = farms.where("soil_ph < 6").unionByName(few(farms, 'farm_id', 5)).unionByName(
        few(farms, 'farm_id', 3).withColumn("district", F.lit("nowhere")).withColumn("soil_ph", F.lit(99).cast("decimal(18,1)")))
    star["dim_weather_stations"] = few(stations, 'station_code', 9).unionByName(few(stations, 'station_code', 2))
    weather = star["fact_weather_observations"]
    star["fact_weather_observations"] = weather.unionByName(
        few(weather, 'station_code', 2).withColumn("season", F.lit("Winter")).withColumn("rainfall_mm", F.lit(0).cast("decimal(18,2)")))
    climate = star["fact_global_climate_environment"]
    star["fact_global_climate_environment"] = climate.unionByName(few(climate, 'observation_id', 4).withColumn("country", F.lit("else")))
    found = same(star, lake.farms)
    failed = {name for name, row in found.items() if not row[3]}
    assert failed >= {"unique_keys", "unresolved_farms", "orphans", "row_counts", "season_words", "soil_ph_range", "profit_rows", "fallback_places"}


def test_empty_tables(lake):
    star = {name: table.limit(0) for name, table in lake.star().items()}
    found = same(star, lake.farms.limit(0))
    assert all(row[1:] == (0, 0, True) for row in found.values())


def test_a_table_is_read_once(lake):
    text = plan(checks.run_standard(lake.star(), lake.farms))
    initial = text[text.index("== Initial Plan ==") if "== Initial Plan ==" in text else 0:]
    scans = [line for line in initial.splitlines() if "FileScan" in line or "Scan parquet" in line]
    assert sum("profit_loss_inr" in s and "match_type" in s for s in scans) == 1
    assert sum("soil_ph" in s and "nitrogen" not in s for s in scans) == 1
    # Farms, dimension, fact; the climate fact by two keys; station tables also as lookups; two of no column, for seasons.
    assert len(scans) == 12 and sum("ReadSchema: struct<>" in s for s in scans) == 2


def test_contract_faults_are_the_contract_violations(spark, lake):
    tables, contracts = {**lake.star(), **lake.rollups}, {**STAR, **ROLLUPS}

    def both():
        single = quality.union_all([quality.contract_violations(tables[n], contracts[n]) for n in tables])
        compiled = checks.contract_faults(tables, contracts)
        assert compiled.dtypes == single.dtypes and rows(compiled) == rows(single)
        return rows(compiled)

    assert len(both()) == sum(len(c.columns) for c in contracts.values())
    facts = tables["fact_crop_yield"]
    tables["fact_crop_yield"] = facts.withColumn(
        "season", F.when(facts.farm_id > "F", F.lit("a very long season"))).withColumn(
        "profit_loss_inr", F.when(F.col("profit_loss_inr") > 0, F.lit(10**11).cast("decimal(18,2)"))).withColumn("match_type", F.lit(None).cast("string"))
    found = {(r[0], r[1]): r[2:] for r in both()}
    assert found["fact_crop_yield", "match_type"] == (facts.count(), 0, 0)
    assert found["fact_crop_yield", "profit_loss_inr"][2] > 0 and sum(found["fact_crop_yield", "season"]) == facts.count()


def test_a_check_stores_only_the_tables_that_it_reads(spark, small_dir):
    from fieldlake.registry import QUERIES

    for name, tables in {"dq_unresolved": {"fact_crop_yield"}, "dq_ph_range": {"dim_farms"}, "dq_station_ids": {"fact_global_climate_environment"}}.items():
        lake = Lake(spark, small_dir)
        found = rows(QUERIES[name](lake))
        assert set(lake._tables) == tables
        assert found == [r for r in rows(checks.run_standard(lake.star(), lake.farms)) if r[0] == found[0][0]]
        lake.close()
