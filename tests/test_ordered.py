import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan, rows
from fieldlake.operators.ordered import approximate_quantiles, exact_quantiles, running_average


def profits(spark, n=2000):
    """Half of the rows share one day; some days and values are missing."""
    rng = random.Random(7)
    data = [
        (
            f"f{i:05d}",
            None if i % 97 == 0 else "2020-06-01" if i % 2 else f"2020-0{rng.randrange(1, 9)}-11",
            None if i % 31 == 0 else round(rng.uniform(-999, 999), 2),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(data, "id string, day string, value double").withColumn(
        "day", F.to_date("day")
    )


def naive(df):
    w = Window.orderBy("day", "id").rowsBetween(Window.unboundedPreceding, 0)
    exact = F.col("value").cast("decimal(18,2)")
    total, n = F.sum(exact).over(w), F.count(exact).over(w)
    return df.select("*", F.round(F.try_divide(total, n), 2).cast("double").alias("avg"))


@pytest.mark.parametrize("partitions", ["1", "4", "17"])
def test_running_average_equals_plain_window(spark, settings, partitions):
    settings(spark__sql__shuffle__partitions=partitions)
    df = profits(spark)
    fast = running_average(df.repartition(5), "day", "id", "value", "avg")
    assert rows(fast) == rows(naive(df))


def test_running_average_comes_out_in_order(spark):
    got = [(r.day, r.id) for r in running_average(profits(spark, 500), "day", "id", "value", "avg").collect()]
    assert got == sorted(got, key=lambda p: (p[0] is not None, p[0] or 0, p[1]))


def test_only_range_totals_meet_in_one_task(spark):
    text = plan(running_average(profits(spark), "day", "id", "value", "avg"))
    assert text.count("SinglePartition") == 1
    below = text[text.index("SinglePartition"):].splitlines()[1]
    assert "HashAggregate" in below and "_part" in below


def test_running_average_of_nothing(spark):
    assert running_average(profits(spark).where("id = 'x'"), "day", "id", "value", "avg").count() == 0


def test_quantiles_against_numpy(spark):
    rng = random.Random(3)
    data = [("hot" if i % 3 else "cold", float(rng.choice([1, 2, 2, 5, rng.random() * 9]))) for i in range(900)]
    data += [("single", 4.0), (None, 1.0), (None, 3.0), ("hot", None)]
    df = spark.createDataFrame(data, "g string, x double")
    probabilities = [0, 0.2, 0.4, 0.6, 0.8, 1]
    got = {r.g: (r.n, r.quantiles) for r in exact_quantiles(df, "x", probabilities, ["g"]).collect()}
    for group in ("hot", "cold", "single", None):
        values = [x for g, x in data if g == group and x is not None]
        assert got[group][0] == len(values)
        assert np.allclose(got[group][1], np.quantile(values, probabilities))


def test_quantile_of_everything(spark):
    df = spark.sql("select cast(id as double) as x from range(1, 5)")
    assert exact_quantiles(df, "x", [0.5]).first().quantiles == [2.5]
    assert approximate_quantiles(df, "x", [0.5]).first().quantiles == [2.0]
