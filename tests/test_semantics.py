"""Agreed meanings where several readings are possible, on tiny stars."""

import pytest

from conftest import rows
from fieldlake.plans import analysis, charts, model, rollups


def facts(spark, *farms):
    """(id, station, crop, reported rain, profit, pest, health, sustainability)"""
    frame = spark.createDataFrame(
        list(farms),
        "farm_id string, matched_station_code string, crop string, rain double, profit double,"
        " pest string, health int, sustain int",
    )
    fact = frame.selectExpr(
        "farm_id", "matched_station_code", "cast(rain as decimal(18,2)) as farm_reported_rainfall_mm",
        "cast(profit as decimal(18,2)) as profit_loss_inr", "cast(1 as decimal(18,2)) as yield_gap_tonnes",
        "cast(profit as decimal(18,2)) as actual_yield_tonnes", "pest as pest_attack",
        "cast(health as decimal(18,2)) as crop_health_score",
        "cast(sustain as decimal(18,2)) as sustainability_score", "'Rabi' as season",
    )
    return fact, frame.selectExpr("farm_id", "'S' as state", "crop")


def weather(spark, *stations):
    """(code, rain, flood, cyclone)"""
    frame = spark.createDataFrame(
        list(stations), "station_code string, rain double, flood_warning string, cyclone_alert string"
    )
    return frame.selectExpr(
        "station_code", "cast(rain as decimal(18,2)) as rainfall_mm", "flood_warning", "cyclone_alert",
        "'Winter' as season",
    )


@pytest.fixture
def star(spark):
    fact, dim = facts(
        spark,
        ("a", "s1", "C", 10.0, 5.0, "Yes", 40, 70), ("b", "s1", "C", 30.0, -5.0, "NO", 60, 70),
        ("c", "s2", "C", 4.0, 0.0, None, 50, 70), ("d", None, "C", 4.0, None, "Yes", 50, 70),
    )
    return fact, dim, weather(spark, ("s1", 10.0, "yes", None), ("s2", 0.0, "No", "No"))


def test_flags_count_whatever_their_case(star):
    got = rows(rollups.climate_risk(rollups.farm_sums(rollups.farm_weather(*star))))
    assert [r[2:4] for r in got] == [("Flood/Cyclone Alert", 50.0), ("No Alert", 0.0)]


def test_pest_rate_among_known_flags_differs_from_rate_of_all(star):
    got = {r.has_alert: r for r in charts.pest_rate_by_alert(rollups.farm_weather(*star)).collect()}
    assert got["No Alert"].pest_attack_rate_pct is None
    assert (got["Alert Triggered"].pest_yes, got["Alert Triggered"].pest_no) == (1, 1)


def test_three_gap_definitions(spark, star):
    joined = rollups.farm_weather(*star)
    sums = rollups.farm_sums(joined)
    # ratio of means: (0 + 20 + 4) / (10 + 10 + 0)
    assert rollups.yield_weather(sums).first().rainfall_reporting_gap_pct == 120.0
    # mean of row ratios leaves the dry station out: (0 % + 200 %) / 2
    assert analysis.rainfall_gap_by_state(*star).first().avg_gap_percentage == 100.0
    assert charts.rainfall_gap_signed(joined).first().rainfall_gap_mm == 8.0


def test_dry_stations_only_give_no_ratio(spark):
    fact, dim = facts(spark, ("a", "s", "C", 10.0, 5.0, "Yes", 40, 70))
    dry = (fact, dim, weather(spark, ("s", 0.0, "No", "No")))
    assert rollups.yield_weather(rollups.farm_sums(rollups.farm_weather(*dry))).first().rainfall_reporting_gap_pct is None
    assert analysis.rainfall_gap_by_state(*dry).first().avg_gap_percentage is None


def test_colliding_columns_carry_a_suffix(star):
    joined = rollups.farm_weather(*star)
    assert joined.first().season == "Rabi" and joined.first().season_station == "Winter"
    assert len(set(joined.columns)) == len(joined.columns)


def test_rounded_means_tie_and_unrounded_do_not(spark):
    farms = [(f"a{i}", None, "A", 0.0, 1.0, "No", 1, 70) for i in range(999)]
    farms += [("a", None, "A", 0.0, 1.0, "No", 1, 71), ("b", None, "B", 0.0, 1.0, "No", 1, 70)]
    fact, dim = facts(spark, *farms)
    assert {r.sustainability_rank for r in analysis.rank_crops_by_sustainability(fact, dim).collect()} == {1}
    assert [r.crop for r in analysis.best_crop_per_state(fact, dim).collect()] == ["A"]
    assert [r.crop for r in analysis.highest_yield_crop(fact, dim).collect()] == ["A", "B"]


def test_states_without_alerts_follow_not_in(star, spark):
    fact, dim, seen = star
    assert analysis.states_without_alerts(fact, dim, seen).count() == 0
    assert rows(analysis.states_without_alerts(fact, dim, seen.where("station_code = 's2'"))) == [("S",)]
    unknown = dim.selectExpr("farm_id", "cast(null as string) as state", "crop")
    assert analysis.states_without_alerts(fact, unknown.unionByName(dim.limit(0)), seen).count() == 0


def test_latest_reading_per_station(spark):
    feed = spark.sql("select 's' as station_code, 'n' as station_name, 'x' as state, 'y' as district,"
                     " d as observation_date, 'Winter' as season, v as max_temp_c"
                     " from values ('2020-01-01', 1D), ('2021-01-01', 3D), ('2021-01-01', 2D), ('soon', 9D) as t(d, v)")
    filler = [c for c in model.FACT_WEATHER.columns if c not in feed.columns]
    full = feed.selectExpr("*", *[f"1 as {c}" for c in filler])
    clean = model.clean_stations(full)
    assert clean.count() == 3
    latest = model.fact_weather(clean).first()
    assert (str(latest.observation_date), float(latest.max_temp_c)) == ("2021-01-01", 2.0)


def test_profit_split_and_overview_ignore_missing_profit(star):
    fact, dim, _ = star
    assert rows(charts.profit_split(fact)) == [(1, 2)]
    shown = charts.overview(fact, dim.selectExpr("*", "crop as crop_variety")).first()
    assert (shown.total_farms, shown.loss_pct, shown.stations_matched) == (4, 25.0, 2)


def test_unknown_profit_driver(star):
    with pytest.raises(ValueError):
        charts.profit_trend(rollups.farm_weather(*star), "Moon phase")
