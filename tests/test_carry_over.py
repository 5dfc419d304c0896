import os

import pytest

from conftest import plan, rows
from fieldlake.contracts import STAR
from fieldlake.plans import pipeline
from fieldlake.sinks import manifest
from fieldlake.sinks.publish import Snapshot, current, retire
from fieldlake.sources.derived import derive_feed
from fieldlake.sources.feeds import FEED_FILES
from fieldlake.sources.tables import load_tables, read_table


def weather(spark, values):
    """Rows of the weather fact: (code, season, rain)."""
    columns = STAR["fact_weather_observations"].columns
    own = [[code if c == "station_code" else season if c == "season" else float(rain) if c == "rainfall_mm" else None for c in columns]
           for code, season, rain in values]
    return spark.createDataFrame(own, ", ".join(f"{c} {'double' if c == 'rainfall_mm' else 'string'}" for c in columns))


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("part-*")}


def test_digest_follows_content_not_order(spark):
    a = spark.sql("select * from values (1,'x',cast(null as string)),(2,null,'y'),(2,null,'y') as t(a,b,c)")
    same = manifest.content(a.repartition(3), None)
    assert manifest.content(a.orderBy("a").select("c", "b", "a"), None) == same
    for other in ("(1,'x',null),(2,null,'y')", "(1,null,'x'),(2,null,'y'),(2,null,'y')", "(1,'x',null),(2,null,'y'),(2,null,'z')"):
        assert manifest.content(spark.sql(f"select * from values {other} as t(a,b,c)"), None) != same
    by = manifest.content(spark.sql("select * from values (1,'p'),(2,''),(3,null) as t(a,b)"), "b")
    assert {value: rows for value, (rows, _) in by.items()} == {"p": 1, None: 2}


def test_only_changed_partitions_are_written(spark, tmp_path):
    target = str(tmp_path)
    data = [("S1", "Rabi", 1), ("S2", "Kharif", 2), ("S3", "it's a/b \\ c", 3), ("S4", None, 4), ("S5", "Zaid", 5)]

    def publish(values):
        run = Snapshot(spark, target, carry=True)
        run.write("fact_weather_observations", weather(spark, values))
        run.commit()
        return run

    first = publish(data)
    assert len(first.changed["fact_weather_observations"]) == 5
    before = files(tmp_path)
    second = publish([*data[:1], ("S2", "Kharif", 9), *data[2:4], ("S6", "Summer", 6)])
    assert second.changed["fact_weather_observations"] == ["Kharif", "Summer"]
    assert {k: v for k, v in files(tmp_path).items() if k in before} == before
    table = read_table(spark, current(spark, target), "fact_weather_observations")
    found = sorted(((r.station_code, r.season, r.rainfall_mm) for r in table.collect()), key=repr)
    assert found == sorted([("S1", "Rabi", 1), ("S2", "Kharif", 9), *data[2:4], ("S6", "Summer", 6)], key=repr)
    # A vanished season is gone, and a filter still prunes partitions.
    assert table.where("season = 'Zaid'").count() == 0 and table.where("season is null").count() == 1
    assert "PartitionFilters: [isnotnull(season" in plan(table.where("season = 'Rabi'"))
    third = publish([*data[:1], ("S2", "Kharif", 9), *data[2:4], ("S6", "Summer", 6)])
    assert third.changed["fact_weather_observations"] == [] and not (tmp_path / f"run={third.run}" / "fact_weather_observations").exists()
    assert rows(read_table(spark, current(spark, target), "fact_weather_observations")) == rows(table)

    # Only what no later run refers to goes.
    assert retire(spark, target, 1) == [first.run, second.run]
    assert rows(read_table(spark, current(spark, target), "fact_weather_observations")) == rows(weather(
        spark, [*data[:1], ("S2", "Kharif", 9), *data[2:4], ("S6", "Summer", 6)]))
    assert not any("Zaid" in f or f"run={first.run}/fact_weather_observations/season=Kharif" in f for f in files(tmp_path))
    last = publish([("S1", "Rabi", 7)])
    retire(spark, target, 1)
    assert [f for f in os.listdir(target) if f.startswith("run=")] == [f"run={last.run}"]


def test_another_layout_is_written_whole(spark, tmp_path):
    def publish(frame, buckets):
        run = Snapshot(spark, str(tmp_path), carry=True)
        run.write("dim_farms", frame, buckets)
        run.commit()
        return run.changed["dim_farms"]

    farms = spark.range(20).selectExpr("cast(id as string) as farm_id", *[f"'v' as {c}" for c in STAR["dim_farms"].columns[1:]])
    assert publish(farms, 3) == [None] and publish(farms.repartition(5), 3) == []
    assert publish(farms, 4) == [None] and publish(farms.withColumn("soil_type", farms.farm_id.cast("int")), 4) == [None]
    assert publish(farms.limit(0), 4) == [None]
    assert read_table(spark, current(spark, str(tmp_path)), "dim_farms").count() == 0


@pytest.fixture(scope="module")
def feeds(spark, small_dir):
    return {name: derive_feed(spark, small_dir, name) for name in FEED_FILES}


def test_a_change_in_one_season_rewrites_that_season(spark, feeds, tmp_path, settings):
    target = str(tmp_path / "out")
    pipeline.refresh(feeds, target)
    first = current(spark, target)
    before, stored = load_tables(spark, first), files(tmp_path / "out")
    farm = before["fact_crop_yield"].where("season = 'Rabi'").agg({"farm_id": "min"}).first()[0]
    changed = feeds["feed_farms"].selectExpr(
        "* except (crop_health_score)", f"if(farm_id = '{farm}', crop_health_score + 1, crop_health_score) as crop_health_score"
    ).select(*feeds["feed_farms"].columns)
    pipeline.refresh(feeds | {"feed_farms": changed}, target)
    found = current(spark, target)
    run = found.path.rpartition("run=")[2]
    own = {
        name: [part.value for part in m.parts if part.run == run]
        for name, m in manifest.manifests(spark, found.path).items()
    }
    assert own["fact_crop_yield"] == ["Rabi"]
    assert own["dim_farms"] == own["dim_weather_stations"] == own["fact_weather_observations"] == []
    assert own["fact_global_climate_environment"] == own["global_environment_summary"] == own["yield_weather_correlation"] == []
    assert {k: v for k, v in files(tmp_path / "out").items() if k in stored} == stored
    after = load_tables(spark, found)
    moved = before["fact_crop_yield"].exceptAll(after["fact_crop_yield"])
    assert [r.farm_id for r in moved.collect()] == [farm]
    for name in ("dim_farms", "fact_global_climate_environment"):
        assert rows(after[name]) == rows(before[name])
    # Carried files keep their buckets: the published join needs no shuffle.
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    joined = after["fact_crop_yield"].select("farm_id", "profit_loss_inr").join(after["dim_farms"].select("farm_id", "state"), "farm_id")
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
