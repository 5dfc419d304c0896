import math
import random

import numpy as np
import pytest

from conftest import rows
from fieldlake.operators.moments import correlations_of, merged, moments, triangle
from fieldlake.operators.stats import correlation_matrix, correlations
from fieldlake.plans import charts
from fieldlake.plans.lake import Lake

COLUMNS = ["x", "y", "z", "flat"]


def data(offset=0.0, n=600, gaps=True):
    draw = random.Random(4)
    out = []
    for i in range(n):
        x = draw.gauss(0, 1)
        row = [f"p{i % 7}", offset + x, offset + 0.5 * x + draw.gauss(0, 1), offset - x * x, 0.1]
        if gaps and i % 11 == 0:
            row[1 + i % 3] = None
        out.append(tuple(row))
    return out + [("alone", offset + 1.0, offset + 2.0, offset, 0.1), (None, offset, offset, offset, 0.1)]


def frame(spark, values):
    return spark.createDataFrame(values, "part string, x double, y double, z double, flat double").repartition(5)


@pytest.mark.parametrize("gaps", [True, False])
def test_parts_give_the_correlations_of_all_rows(spark, gaps):
    df = frame(spark, data(gaps=gaps))
    parts = moments(df, "part", triangle(COLUMNS), complete=not gaps)
    assert rows(correlations_of(parts, triangle(COLUMNS))) == rows(correlation_matrix(df, COLUMNS))
    some = "part IN ('p1', 'p4', 'alone')"
    assert rows(correlations_of(parts.where(some), triangle(COLUMNS))) == rows(correlation_matrix(df.where(some), COLUMNS))
    # Either way round, a pair that was never measured, and a part with one row.
    assert rows(correlations_of(parts, [("x", "y"), ("x", "none")])) == [("x", "none", None), *rows(correlations(df, [("x", "y")]))]
    assert correlations_of(parts.where("part = 'alone'"), [("x", "y")]).first().r is None


def test_large_means_lose_no_digits(spark):
    values = data(offset=1e9, gaps=False)
    found = {(r.a, r.b): r for r in merged(moments(frame(spark, values), "part", [("x", "y")], complete=True)).collect()}
    x, y = (np.array([v[k] for v in values]) for k in (1, 2))
    row = found["x", "y"]
    assert row.n == len(values) and row.mean_a == pytest.approx(x.mean(), rel=1e-12)
    assert row.square_a == pytest.approx(((x - x.mean()) ** 2).sum(), rel=1e-6)
    assert row.product == pytest.approx(((x - x.mean()) * (y - y.mean())).sum(), rel=1e-6)
    # Sums of squares of the values themselves would have lost the variance.
    assert math.isclose(row.square_a / row.n, 1, rel_tol=0.2)


def test_a_second_question_reads_no_facts(spark, small_dir):
    lake = Lake.of(spark, small_dir)
    found = charts.environment_correlations_of(lake.climate_moments)
    files = found.inputFiles()
    assert files and all("climate_moments" in file for file in files)
    assert rows(found) == rows(charts.environment_correlations(lake.fact_climate))
    country = lake.fact_climate.first().country
    assert rows(charts.environment_correlations_of(lake.climate_moments.where(f"part = '{country}'"))) == rows(
        charts.environment_correlations(lake.fact_climate.where(f"country = '{country}'")))


def test_nothing(spark):
    parts = moments(frame(spark, data()).limit(0), "part", [("x", "y")])
    assert rows(correlations_of(parts, [("x", "y")])) == [("x", "y", None)]
