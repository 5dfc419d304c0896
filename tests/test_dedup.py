from pyspark.sql import functions as F

from conftest import plan, rows
from fieldlake.operators import dedup
from fieldlake.operators.dedup import first_per_key, latest_per_key, settled_first_per_key
from fieldlake.plans import model
from fieldlake.plans.lake import Lake


def sample(spark):
    return spark.sql(
        "select * from values ('a', 2, 'x'), ('a', 1, null), ('a', 1, 'z'), ('b', null, 'y'),"
        " ('b', 5, 'y'), (null, 1, 'n'), (null, 0, 'm') as t(k, v, w)"
    )


def test_total_order_with_nulls_last(spark):
    expected = [("a", 1, "z"), ("b", 5, "y"), (None, 0, "m")]
    for df in (sample(spark), sample(spark).orderBy(F.desc("w")), sample(spark).repartition(7)):
        assert rows(first_per_key(df, ["k"])) == sorted(expected, key=repr)


def test_composite_key_and_key_only_frames(spark):
    assert first_per_key(sample(spark), ["k", "v"]).count() == 6
    assert first_per_key(sample(spark).select("k"), ["k"]).count() == 3


def test_latest_ties_and_missing_dates(spark):
    df = spark.sql(
        "select * from values ('s', date'2020-01-02', 2), ('s', date'2020-01-02', 1),"
        " ('s', null, 0), ('t', null, 3) as t(k, d, v)"
    )
    assert [(r.k, r.v) for r in latest_per_key(df, ["k"], "d").orderBy("k").collect()] == [("s", 1), ("t", 3)]


def test_hot_key_shrinks_before_the_shuffle(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    out = first_per_key(df, ["k"])
    assert out.count() == 2001 and out.where("k = 'hot'").first().v == 0
    assert plan(out).count("WindowGroupLimit") == 2


def test_empty(spark):
    assert first_per_key(sample(spark).where("k = 'none'"), ["k"]).count() == 0


def test_settled_dedup_ranks_only_repeated_keys(spark):
    for keys in (["k"], ["k", "v"]):
        expected = rows(first_per_key(sample(spark), keys))
        assert rows(settled_first_per_key(sample(spark), keys, "t")) == expected
        assert rows(settled_first_per_key(sample(spark), keys, "t", most=0)) == expected
    by_latest = [F.col("v").desc_nulls_last()]
    assert rows(settled_first_per_key(sample(spark), ["k"], "t", by_latest)) == rows(first_per_key(sample(spark), ["k"], by_latest))
    assert settled_first_per_key(sample(spark).where("k = 'none'"), ["k"], "t").count() == 0


def test_settled_dedup_neither_sorts_nor_shuffles_single_rows(spark):
    many = spark.range(5000).selectExpr("concat('F', id) AS k", "id AS v").unionByName(
        spark.range(50).selectExpr("concat('F', id) AS k", "id + 1 AS v")
    )
    out = settled_first_per_key(many, ["k"], "t")
    assert out.count() == 5000 and out.where("k = 'F7'").first().v == 7
    single, repeated = plan(out).split("LeftAnti")
    assert "Sort" not in single and plan(out).count("Exchange hashpartitioning") == 1 and "LeftSemi" in repeated


def test_stored_farms_shuffle_only_keys_for_their_dedup(spark, small_dir, monkeypatch):
    ranked = []
    monkeypatch.setattr(dedup, "first_per_key", lambda df, *a: ranked.append(df) or first_per_key(df, *a))
    lake = Lake(spark, small_dir)
    found = lake.farms
    # The farms and the climate rank no row whose key comes once.
    lake.fact_climate
    feed = lake.feed("feed_farms")
    twice = feed.groupBy("farm_id").count().where("count > 1").agg(F.sum("count")).first()[0]
    assert [df.count() for df in ranked][0] == twice < feed.count() and len(ranked) == 2
    assert rows(found) == rows(model.clean_farms(feed))
    lake.close()
