from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan, rows
from fieldlake.plans import rollups
from fieldlake.plans.lake import Lake


def row_by_row(star):
    """The sums over the star joined row by row."""
    joined = rollups.farm_weather(star["fact_crop_yield"], star["dim_farms"], star["fact_weather_observations"])
    return rollups.farm_sums(joined)


def below_the_join(star):
    return rollups.exposure_sums(rollups.farm_weather(
        star["fact_crop_yield"], star["dim_farms"], star["fact_weather_observations"], rollups.station_sums))


@pytest.fixture
def star(spark, small_dir):
    return dict(Lake.of(spark, small_dir).star())


def test_sums_below_the_join_are_the_sums_above_it(star):
    assert below_the_join(star).dtypes == row_by_row(star).dtypes
    assert rows(below_the_join(star)) == rows(row_by_row(star))


def test_nulls_on_either_side(star):
    farms, weather = star["fact_crop_yield"], star["fact_weather_observations"]
    bucket = F.pmod(F.xxhash64("farm_id"), F.lit(10))
    for name, every in (("farm_reported_rainfall_mm", 3), ("profit_loss_inr", 5), ("crop_health_score", 7), ("matched_station_code", 9)):
        farms = farms.withColumn(name, F.when(bucket != every, F.col(name)))
    code = weather.agg(F.min("station_code"), F.max("station_code")).first()
    weather = weather.withColumn("rainfall_mm", F.when(F.col("station_code") != code[0], F.col("rainfall_mm")))
    weather = weather.withColumn("flood_warning", F.when(F.col("station_code") != code[1], F.col("flood_warning")))
    star |= {"fact_crop_yield": farms, "fact_weather_observations": weather}
    assert rows(below_the_join(star)) == rows(row_by_row(star))
    # Nobody reported rain, and no station measured any.
    star["fact_crop_yield"] = farms.withColumn("farm_reported_rainfall_mm", F.lit(None).cast("decimal(18,2)"))
    assert rows(below_the_join(star)) == rows(row_by_row(star))
    star["fact_weather_observations"] = weather.withColumn("rainfall_mm", F.lit(None).cast("decimal(18,2)"))
    assert rows(below_the_join(star)) == rows(row_by_row(star))
    star["fact_crop_yield"] = farms.limit(0)
    assert rows(below_the_join(star)) == []


def test_readings_meet_groups_and_not_farms(spark, star):
    """One station that serves all farms: the join sees a row per state, crop and station."""
    code = star["fact_weather_observations"].agg(F.min("station_code")).first()[0]
    star["fact_crop_yield"] = star["fact_crop_yield"].withColumn("matched_station_code", F.lit(code))
    met = rollups.farm_weather(star["fact_crop_yield"], star["dim_farms"], star["fact_weather_observations"], rollups.station_sums)
    groups = star["dim_farms"].select("state", "crop").distinct().count()
    assert met.count() == groups < star["fact_crop_yield"].count() / 10
    assert met.agg(F.sum("farms")).first()[0] == star["fact_crop_yield"].count()
    total = star["fact_crop_yield"].agg(F.sum("profit_loss_inr")).first()[0]
    assert below_the_join(star).agg(F.sum("sum_profit")).first()[0] == Decimal(total)
    assert rows(below_the_join(star)) == rows(row_by_row(star))


@pytest.mark.parametrize("partitions", ["1", "4", "13"])
def test_numbers_follow_the_keys_without_one_task(spark, settings, partitions):
    settings(spark__sql__shuffle__partitions=partitions)
    df = spark.range(300).selectExpr("if(id % 41 = 0, null, concat('s', id % 17)) as state", "if(id % 37 = 0, null, id) as crop", "id")
    df = df.dropDuplicates(["state", "crop"]).repartition(5)
    numbered = rollups.number_rows(df, ["state", "crop"], "n")
    order = Window.orderBy(F.col("state").asc_nulls_last(), F.col("crop").asc_nulls_last())
    text = plan(numbered)
    assert numbered.columns == ["n", *df.columns]
    assert rows(numbered) == rows(df.select(F.row_number().over(order).cast("long").alias("n"), "*"))
    assert "row_number" not in text
    if partitions != "1":
        assert text.count("SinglePartition") == 1 and "HashAggregate" in text[text.index("SinglePartition"):].splitlines()[1]
    assert rollups.number_rows(df.limit(0), ["state", "crop"], "n").count() == 0
