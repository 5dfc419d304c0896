import datetime as dt
import random

import pytest

from conftest import rows
from fieldlake.operators.resolve import (
    EXACT, NEAREST, UNRESOLVED, Keys, match_exact, match_nearest, match_unmatched, resolve_tiers,
    unmatched_places,
)

D = dt.date
FARM = "farm_id string, state string, district string, sowing_date date"
READING = "station_code string, state string, district string, observation_date date"


def frames(spark, farms, readings):
    left = spark.createDataFrame(farms, FARM)
    right = spark.createDataFrame(readings, READING)
    return left, right.select("station_code", "state", "district").distinct(), right.drop("district")


def resolved(spark, farms, readings):
    left, stations, seen = frames(spark, farms, readings)
    return {r.farm_id: (r.matched_station_code, r.match_type)
            for r in resolve_tiers(left, stations, seen).collect()}


def brute_force(farms, readings):
    out = {}
    for farm, state, district, sown in farms:
        same = [s for s, st, d, _ in readings if state and district and (st, d) == (state, district)]
        if same:
            out[farm] = (min(same), EXACT)
            continue
        near = [(abs((sown - day).days) if sown and day else float("inf"), s)
                for s, st, _, day in readings if state and st == state]
        out[farm] = (min(near)[1], NEAREST) if near else (None, UNRESOLVED)
    return out


def test_exact_takes_smallest_code(spark):
    farms = [("f", "S", "D", D(2020, 1, 1))]
    readings = [("s2", "S", "D", D(2020, 1, 1)), ("s1", "S", "D", D(2010, 1, 1))]
    assert resolved(spark, farms, readings) == {"f": ("s1", EXACT)}


def test_nearest_tie_goes_to_smallest_code(spark):
    farms = [("f", "S", "X", D(2020, 1, 10))]
    readings = [("s2", "S", "D", D(2020, 1, 5)), ("s1", "S", "D", D(2020, 1, 15)),
                ("s0", "S", "D", D(2020, 2, 1))]
    assert resolved(spark, farms, readings) == {"f": ("s1", NEAREST)}


def test_farm_without_region_stations_stays_unresolved(spark):
    farms = [("f", "S", "X", D(2020, 1, 10)), ("g", "T", "X", None)]
    readings = [("s1", "U", "X", D(2020, 1, 10))]
    assert set(resolved(spark, farms, readings).values()) == {(None, UNRESOLVED)}


def test_null_dates_never_win(spark):
    farms = [("f", "S", "X", D(2020, 1, 10)), ("g", "S", "X", None), ("h", "T", "X", D(2020, 1, 1))]
    readings = [("s1", "S", "D", None), ("s2", "S", "D", D(1990, 1, 1)), ("t9", "T", "D", None)]
    assert resolved(spark, farms, readings) == {
        "f": ("s2", NEAREST), "g": ("s1", NEAREST), "h": ("t9", NEAREST)}


def test_null_places_do_not_match(spark):
    farms = [("f", "S", None, D(2020, 1, 10)), ("g", None, None, D(2020, 1, 1))]
    readings = [("s1", "S", None, D(2020, 1, 1)), ("s2", None, None, D(2020, 1, 1))]
    assert resolved(spark, farms, readings) == {"f": ("s1", NEAREST), "g": (None, UNRESOLVED)}


def test_no_stations_at_all(spark):
    assert resolved(spark, [("f", "S", "D", D(2020, 1, 1))], []) == {"f": (None, UNRESOLVED)}
    assert resolved(spark, [], [("s", "S", "D", D(2020, 1, 1))]) == {}


def test_match_nearest_leaves_out_regions_without_readings(spark):
    left, _, seen = frames(
        spark,
        [("f", "S", "X", D(2020, 1, 1)), ("g", "T", "X", D(2020, 1, 1))],
        [("s1", "S", "D", D(2021, 1, 1))],
    )
    assert [(r.farm_id, r.matched_station_code) for r in match_nearest(left, seen).collect()] == [("f", "s1")]


def test_unmatched_parts(spark):
    left, stations, _ = frames(
        spark,
        [("f", "S", "D", None), ("g", "S", "X", None), ("h", "S", "X", None)],
        [("s1", "S", "D", D(2021, 1, 1))],
    )
    assert [r.farm_id for r in match_exact(left, stations).collect()] == ["f"]
    assert sorted(r.farm_id for r in match_unmatched(left, stations).collect()) == ["g", "h"]
    assert rows(unmatched_places(left, stations)) == [("S", "X")]


def test_column_names_are_parameters(spark):
    keys = Keys(place=("zone", "cell"), region=("zone",), left_date="day", right_date="seen",
                code="sensor", target="chosen")
    left = spark.sql("select 1 as id, 'z' as zone, 'c' as cell, date'2020-01-01' as day")
    right = spark.sql("select 'p' as sensor, 'z' as zone, 'd' as cell, date'2020-03-01' as seen")
    assert resolve_tiers(left, right.drop("seen"), right, keys).first().chosen == "p"


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force_with_a_hot_state(spark, seed):
    rng = random.Random(seed)
    states = ["HOT"] * 5 + ["A", "B", None]
    districts = ["d1", "d2", "d3", "d4", None]

    def day():
        return None if rng.random() < 0.1 else D(2020, 1, 1) + dt.timedelta(rng.randrange(120))

    farms = [(f"f{i}", rng.choice(states), rng.choice(districts), day()) for i in range(300)]
    readings = [(f"s{rng.randrange(40):02d}", rng.choice(states[:6] + [None]), rng.choice(["d1", "d2", None]), day())
                for _ in range(80)]
    assert resolved(spark, farms, readings) == brute_force(farms, readings)
