import pytest

from conftest import plan, rows
from fieldlake.plans import model, pipeline, quality, rollups
from fieldlake.plans.lake import Lake
from fieldlake.registry import QUERIES, all_queries
from fieldlake.sinks.files import child_names
from fieldlake.sinks.publish import PublishError, current
from fieldlake.sinks.settle import Owner, settle, shared_dir
from fieldlake.sources.derived import derive_feed
from fieldlake.sources.feeds import FEED_FILES
from fieldlake.sources.tables import load_tables
from fieldlake.streaming.refresh import refresh_on_arrival


@pytest.fixture(scope="module")
def published(spark, small_dir, tmp_path_factory):
    raw, target = tmp_path_factory.mktemp("raw"), str(tmp_path_factory.mktemp("target"))
    for name, file in FEED_FILES.items():
        derive_feed(spark, small_dir, name).write.option("header", True).csv(f"{raw}/{file}")
    counts = pipeline.run(spark, str(raw), target, log_path=f"{target}-log")
    return target, counts


def test_csv_to_published_star(spark, small_dir, published):
    target, counts = published
    assert counts == {"feed_farms": 1515, "feed_stations": 12, "feed_climate": 1010}
    star = load_tables(spark, current(spark, target))
    for name, table in Lake.of(spark, small_dir).star().items():
        assert rows(star[name]) == rows(table), name


def test_arriving_files_refresh_once(spark, small_dir, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()

    def deliver(name, file):
        derive_feed(spark, small_dir, name).coalesce(1).write.option("header", True).csv(f"{tmp_path}/{file}")
        part = next((tmp_path / file).glob("part-*.csv"))
        (raw / file).write_bytes(part.read_bytes())

    def arrive():
        return refresh_on_arrival(spark, str(raw), f"{tmp_path}/landing", f"{tmp_path}/ck", target)

    farms, *others = FEED_FILES
    for name in others:
        deliver(name, FEED_FILES[name])
    assert arrive() is None
    deliver(farms, FEED_FILES[farms])
    unique = {"feed_farms": 1500, "feed_stations": 12, "feed_climate": 1000}
    assert arrive() == unique
    assert arrive() is None
    again = FEED_FILES[farms].replace(".csv", "_again.csv")
    (raw / again).write_bytes((raw / FEED_FILES[farms]).read_bytes())
    before = rows(load_tables(spark, current(spark, target))["fact_crop_yield"])
    assert arrive() == unique
    assert rows(load_tables(spark, current(spark, target))["fact_crop_yield"]) == before


def test_views_and_log(spark, published):
    target, _ = published
    pipeline.open_views(spark, target)
    assert spark.table(pipeline.RAINFALL_GAP_VIEW).count() == 4
    assert spark.table(pipeline.DISASTER_RISK_VIEW).where("country is null").count() == 0
    log = spark.read.option("header", True).csv(f"{target}-log")
    assert log.count() == 10 and log.where("passed = 'false'").first().check_id == "soil_ph_range"


def test_planted_duplicates_leave_the_old_set(spark, small_dir, tmp_path, monkeypatch):
    feeds = {name: derive_feed(spark, small_dir, name) for name in FEED_FILES}
    target = str(tmp_path / "out")
    pipeline.refresh(feeds, target)
    before = current(spark, target).path
    build = model.build_star

    def twice(*args):
        star = build(*args)
        star["fact_crop_yield"] = star["fact_crop_yield"].unionByName(star["fact_crop_yield"].limit(2))
        return star

    monkeypatch.setattr(model, "build_star", twice)
    with pytest.raises(PublishError, match="unique_keys"):
        pipeline.refresh(feeds, target, log_path=f"{target}-log")
    assert current(spark, target).path == before
    log = spark.read.option("header", True).csv(f"{target}-log")
    assert log.where("check_id = 'unique_keys' and passed = 'false'").count() == 1


def test_settled_tables_have_an_owner(spark, small_dir):
    settings_before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.checkpoint.dir")
    folder, lake = shared_dir(spark), Lake(spark, small_dir)
    before = set(child_names(spark, folder))
    tables = {t.name for t in spark.catalog.listTables()}
    first = lake.answer("profit_trend", lambda it: QUERIES["profit_trend_by_land_area"](it))
    stored = set(child_names(spark, folder))
    assert stored > before and first.count() > 0
    assert lake.answer("profit_trend", QUERIES["profit_trend_by_land_area"]) is first
    assert set(child_names(spark, folder)) == stored
    lake.close()
    assert set(child_names(spark, folder)) == before
    assert {t.name for t in spark.catalog.listTables()} == tables
    with Owner(spark):
        settle(spark.range(3), "mine")
        assert len(child_names(spark, folder)) == len(before) + 1
    assert set(child_names(spark, folder)) == before
    assert settings_before == (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.checkpoint.dir"))


def test_matches_cover_all_tiers(spark, small_dir):
    counts = dict(rows(all_queries()["match_type_counts"](spark, small_dir)))
    assert counts == {"Exact District Match": 355, "Nearest In State": 808, "Unresolved": 337}


def test_bucketed_star_joins_without_a_shuffle(spark, small_dir, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    lake = Lake.of(spark, small_dir)
    joined = lake.fact_yield.select("farm_id", "profit_loss_inr").join(
        lake.dim_farms.select("farm_id", "state"), "farm_id")
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)


def test_published_star_joins_without_a_shuffle(spark, published, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    star = load_tables(spark, current(spark, published[0]))
    joined = star["fact_crop_yield"].select("farm_id", "profit_loss_inr").join(
        star["dim_farms"].select("farm_id", "state"), "farm_id")
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    text = plan(star["fact_crop_yield"].where("season = 'Rabi'").select("farm_id"))
    assert "PartitionFilters: [isnotnull(season" in text


def test_rollups_join_the_star_once(spark, small_dir, monkeypatch):
    star, joins = Lake.of(spark, small_dir).star(), []
    join = rollups.farm_weather
    monkeypatch.setattr(rollups, "farm_weather", lambda *tables: joins.append(1) or join(*tables))
    bodies = rollups.rollup_bodies(star)
    assert len(joins) == 1
    for name in ("yield_weather_correlation", "climate_risk_farms"):
        assert "Join" not in plan(bodies[name])


def test_season_filter_prunes_partitions(spark, small_dir):
    text = plan(Lake.of(spark, small_dir).fact_yield.where("season = 'Rabi'").select("farm_id"))
    assert "PartitionFilters: [isnotnull(season" in text


def test_checks_find_planted_faults(spark, small_dir):
    star = dict(Lake.of(spark, small_dir).star())
    facts = star["fact_crop_yield"]
    star["fact_crop_yield"] = facts.unionByName(facts.limit(2)).selectExpr(
        "* except (matched_station_code, season)", "'gone' as matched_station_code", "'Winter' as season")
    star["fact_weather_observations"] = star["fact_weather_observations"].selectExpr(
        "* except (season)", "'Winter' as season")
    checks = [quality.check_unique_keys, quality.check_orphans, quality.check_unresolved,
              quality.check_season_words]
    got = {r.check_id: r for r in quality.run_checks(star, checks).collect()}
    assert got["unique_keys"].violations == 2
    assert got["orphans"].violations == 1502
    assert got["unresolved_farms"].violations > 0 and got["season_words"].violations == 1
    assert not any(r.passed for r in got.values())


def test_large_gap_counts_dry_stations(spark):
    df = spark.sql("select * from values (0D,0D),(1D,0D),(12D,10D),(12.1D,10D),(null,1D)"
                   " as t(farm_reported_rainfall_mm, rainfall_mm)")
    assert [r[0] for r in df.select(quality.large_gap()).collect()] == [False, True, False, True, None]
