import logging
import os
import threading

import pytest

from conftest import plan, rows
from fieldlake.contracts import PUBLISH_ORDER
from fieldlake.sinks.database import write_options
from fieldlake.sinks.files import next_pointer
from fieldlake.sinks.publish import PublishError, current, publish, require_clean_contracts, retire
from fieldlake.sinks.small import create_view, write_log, write_summary
from fieldlake.sources.tables import (
    Database, Files, MissingTableError, Split, jdbc_options, load_tables, read_table,
)


def stations(spark, code="S1", name="'n'"):
    return spark.sql(f"select '{code}' as station_code, {name} as station_name, 'S' as state, 'D' as district")


def test_readers_follow_the_pointer(spark, tmp_path):
    target = str(tmp_path)
    with pytest.raises(MissingTableError):
        current(spark, target)
    first = publish(spark, {"dim_weather_stations": stations(spark)}, target)
    second = publish(spark, {"dim_weather_stations": stations(spark)}, target)
    assert first != second and current(spark, target).path.endswith(second)
    assert read_table(spark, current(spark, target), "dim_weather_stations").count() == 1


def test_a_reader_never_fails_during_switches(spark, tmp_path):
    target = str(tmp_path)
    publish(spark, {"dim_weather_stations": stations(spark)}, target)
    seen, errors, done = set(), [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.add(current(spark, target).path)
            except Exception as error:
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(20):
        next_pointer(spark, f"{target}/CURRENT", f"run{i}")
    done.set()
    reader.join()
    assert not errors and current(spark, target).path.endswith("run=run19") and len(seen) > 1


def test_pointers_that_say_nothing_are_not_followed(spark, tmp_path):
    target = str(tmp_path)
    (tmp_path / "CURRENT").mkdir()
    (tmp_path / "CURRENT" / "000000000001-").touch()
    (tmp_path / "CURRENT" / "note").touch()
    with pytest.raises(MissingTableError):
        current(spark, target)


def test_superseded_runs_are_retired(spark, tmp_path):
    target = str(tmp_path)
    runs = [publish(spark, {"dim_weather_stations": stations(spark)}, target) for _ in range(3)]
    assert retire(spark, target, 2) == runs[:1]
    assert sorted(f for f in os.listdir(target) if f.startswith("run=")) == sorted(f"run={r}" for r in runs[1:])
    assert current(spark, target).path.endswith(runs[2])
    with pytest.raises(ValueError):
        retire(spark, target, 0)


def test_failed_run_leaves_the_old_tables(spark, tmp_path):
    target = str(tmp_path)
    publish(spark, {"dim_weather_stations": stations(spark, "old")}, target)
    bad = stations(spark, "new", "cast(null as string)")
    with pytest.raises(PublishError, match="dim_weather_stations.station_name"):
        publish(spark, {"dim_weather_stations": bad}, target, require_clean_contracts)
    table = read_table(spark, current(spark, target), "dim_weather_stations")
    assert table.first().station_code == "old"


def test_extra_column_breaks_the_contract(spark):
    with pytest.raises(PublishError):
        require_clean_contracts({"dim_weather_stations": stations(spark).selectExpr("*", "1 as extra")})


def test_missing_table_and_fallback(spark, tmp_path, caplog):
    source = Files(str(tmp_path))
    with pytest.raises(MissingTableError):
        load_tables(spark, source, ["dim_weather_stations"])
    stations(spark).write.parquet(f"{tmp_path}/dim_weather_stations")
    nowhere = Database("jdbc:nosuch://nowhere/db", {"driver": "no.such.Driver"})
    with caplog.at_level(logging.WARNING):
        found = load_tables(spark, nowhere, ["dim_weather_stations"], fallback=source)
    assert found["dim_weather_stations"].count() == 1 and "cannot be reached" in caplog.text
    with pytest.raises(Exception, match="No suitable driver"):  # a mistake is no reason to read older data
        load_tables(spark, Database("jdbc:x"), ["dim_weather_stations"], fallback=source)


def test_database_options():
    source = Database("jdbc:x", {"user": "u"}, {"t": Split("id", "0", "100", 8)}, fetch_rows=500)
    assert jdbc_options(source, "t")["numPartitions"] == "8"
    assert "partitionColumn" not in jdbc_options(source, "other")
    assert write_options(source, "t", 4, 100) == {
        "url": "jdbc:x", "dbtable": "t", "numPartitions": "4", "batchsize": "100", "user": "u"}
    assert PUBLISH_ORDER.index("dim_farms") < PUBLISH_ORDER.index("fact_crop_yield")


def test_small_outputs(spark, tmp_path):
    df = spark.range(3)
    write_log(df, str(tmp_path / "log"))
    assert sum(f.endswith(".csv") for f in os.listdir(tmp_path / "log")) == 1
    assert rows(write_summary(df, str(tmp_path / "sum"))) == [(0,), (1,), (2,)]
    create_view(df, "numbers")
    create_view(df.limit(1), "numbers")
    assert spark.table("numbers").count() == 1


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    df = spark.sql("select 'a' as k, 'Rabi' as season union all select 'b', 'Zaid'")
    df.write.partitionBy("season").parquet(str(tmp_path / "t"))
    text = plan(read_table(spark, Files(str(tmp_path)), "t").where("season = 'Rabi'"))
    assert "PartitionFilters: [isnotnull(season" in text
