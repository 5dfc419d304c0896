"""Every query against its SQL counterpart on an independent engine."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import plan, rows
from fieldlake import oracle, registry
from fieldlake.plans.lake import Lake
from fieldlake.sinks.settle import settle_table

duckdb = pytest.importorskip("duckdb")

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def engine(small_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{small_dir}/{table}.parquet'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(registry.all_queries()) == set(oracle.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(registry.all_queries())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_result(spark, small_dir, engine, name):
    frame = entry.queries()[name](spark, small_dir)
    # No query pairs rows without a key.
    assert not {"CartesianProduct", "BroadcastNestedLoopJoin"} & set(re.findall(r"\w+", plan(frame)))
    columns = sorted(frame.columns)
    result = engine.execute(entry.oracle_sql()[name])
    found = [c[0] for c in result.description]
    assert sorted(found) == columns
    order = [found.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)
    assert rows(frame.select(*columns)) == expected


@pytest.mark.parametrize("partitions", ["1", "17"])
@pytest.mark.parametrize("name", ["match_two_tier", "running_avg_profit", "profit_trend_by_bin"])
def test_partitioning_does_not_matter(spark, small_dir, settings, name, partitions):
    before = rows(entry.queries()[name](spark, small_dir))
    settings(spark__sql__shuffle__partitions=partitions)
    lake = Lake(spark, small_dir)
    assert rows(registry.portable(registry.QUERIES[name](lake))) == before
    lake.close()


SHUFFLED = sorted(set(oracle.oracle_sql()) - {"ingest_row_counts", "stage_row_counts"})


@pytest.fixture(scope="module")
def shuffled_lake(spark, small_dir):
    """The star with its rows dealt anew and in another order."""
    lake, base = Lake(spark, small_dir), Lake.of(spark, small_dir)
    for name in ("dim_farms", "fact_crop_yield", "fact_weather_observations", "fact_global_climate_environment"):
        df = base.star()[name].repartition(7, F.rand(3)).sortWithinPartitions(F.rand(5))
        with lake.owner.open():
            lake._tables[name] = settle_table(df, name)
    for name, df in (("clean_farms", base.farms), ("clean_stations", base.stations), ("dim_weather_stations", base.dim_stations)):
        lake._once(name, lambda df=df: df.repartition(5, F.rand(1)))
    yield lake
    lake.close()


@pytest.mark.parametrize("name", SHUFFLED)
def test_row_order_does_not_matter(spark, small_dir, shuffled_lake, name):
    expected = rows(entry.queries()[name](spark, small_dir))
    assert rows(registry.portable(registry.QUERIES[name](shuffled_lake))) == expected


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["state", "crop", "avg_profit_loss_inr", "total_farms"]
    assert frame.count() == 25
