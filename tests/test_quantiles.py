import math
import random

import numpy as np
import pytest

from conftest import plan
from fieldlake.operators import quantiles
from fieldlake.operators.quantiles import exact_quantiles

STEPS = [0, 0.01, 0.25, 0.5, 0.5, 0.9, 0.999, 1]


def spread(kind, n):
    draw = random.Random(f"{kind}{n}")
    return {
        "even": lambda: draw.uniform(-5, 5),
        "far": lambda: 10 ** draw.uniform(-300, 300) * draw.choice([-1, 1]),
        "ends": lambda: draw.choice([-1.7e308, 1.7e308, 5e-324, -0.0, 0.0]),
        "outlier": lambda: 1e300 if draw.random() < 0.002 else draw.random(),
        "few": lambda: float(draw.choice([1, 2, 2, 3])),
        "same": lambda: 7.25,
        "close": lambda: 1 + draw.randrange(3) * 2**-52,
    }[kind]


@pytest.mark.parametrize("cells, rounds", [(4096, None), (4096, 1), (8, 1), (5, 4), (2, 7)])
def test_any_spread_any_number_of_rounds(spark, cells, rounds):
    data = []
    for kind in ("even", "far", "ends", "outlier", "few", "same", "close"):
        for n in (1, 2, 700):
            one = spread(kind, n)
            data += [(f"{kind}{n}", one()) for _ in range(n)]
    df = spark.createDataFrame(data + [(None, 3.0), (None, 1.0), ("even1", None)], "g string, x double").repartition(5)
    found = {r.g: r for r in exact_quantiles(df, "x", STEPS, ["g"], rounds=rounds, cells=cells).collect()}
    groups = {}
    for g, x in [*data, (None, 3.0), (None, 1.0)]:
        groups.setdefault(g, []).append(x)
    assert set(found) == set(groups)
    for g, values in groups.items():
        values, n = sorted(values), len(values)
        assert found[g].n == n
        for p, got in zip(STEPS, found[g].quantiles):
            at = p * (n - 1)
            low, high = values[math.floor(at)], values[math.ceil(at)]
            assert got == (low if low == high else low + (high - low) * (at - math.floor(at))), (g, p)


@pytest.mark.parametrize("rounds", [None, 1, 3])
def test_values_that_are_not_finite(spark, rounds):
    inf, nan = math.inf, math.nan
    df = spark.createDataFrame([(x,) for x in [nan, inf, -inf, 2.0, 1.0, inf, -inf]], "x double")
    (row,) = exact_quantiles(df, "x", [0, 1 / 6, 2 / 6, 3 / 6, 4 / 6, 5 / 6, 1], cells=4, rounds=rounds).collect()
    assert row.quantiles[:6] == [-inf, -inf, 1.0, 2.0, inf, inf] and math.isnan(row.quantiles[6])


@pytest.mark.parametrize("rounds", [None, 2])
def test_decimals_and_nothing(spark, rounds):
    df = spark.sql("select cast(id as decimal(18,2)) / 4 as x from range(101)")
    (row,) = exact_quantiles(df, "x", [0.5, 0.1], rounds=rounds).collect()
    assert (row.n, row.quantiles) == (101, [12.5, 2.5])
    assert exact_quantiles(df.where("x < 0"), "x", [0.5], rounds=rounds).collect() == []
    assert exact_quantiles(df.where("x < 0").selectExpr("x", "1 as g"), "x", [0.5], ["g"], rounds).collect() == []


def test_no_global_order(spark, monkeypatch):
    settled = []
    inner = quantiles.settle
    monkeypatch.setattr(quantiles, "settle", lambda df, label: settled.append(plan(df)) or inner(df, label))
    values = np.random.default_rng(1).normal(size=5000).tolist()
    df = spark.createDataFrame([(i % 3, x) for i, x in enumerate(values)], "g int, x double")
    last = exact_quantiles(df, "x", [0.2, 0.5, 0.8], ["g"], rounds=2)
    plans = [*settled, plan(last)]
    assert len(plans) == 3 and all("rangepartitioning" not in p and "SinglePartition" not in p for p in plans)
    assert {r.n for r in last.collect()} == {1666, 1667}


def test_rounds_follow_the_size(spark, monkeypatch):
    done = []
    inner = quantiles._refined
    monkeypatch.setattr(quantiles, "_refined", lambda *a: done.append(1) or inner(*a))
    df = spark.range(1000).selectExpr("cast(id as double) as x")
    for size, rounds in ((0, 0), (16 << 20, 0), (17 << 20, 1), (60 << 30, 1), (200 << 40, 2)):
        monkeypatch.setattr(quantiles, "stored_bytes", lambda *a: size)
        done.clear()
        assert exact_quantiles(df, "x", [0.5]).first().quantiles == [499.5] and len(done) == rounds
