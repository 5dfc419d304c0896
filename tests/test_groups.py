import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fieldlake.functions import mean
from fieldlake.operators.bins import fixed_bins, quantile_trend
from fieldlake.operators.groups import (
    contrast, crosstab, means_by, ordered_means, rank_groups, share_of_parent, widen,
)
from fieldlake.operators.joins import not_in, orphans, star_join
from fieldlake.operators.stats import (
    attribute_spread, correlation_matrix, correlations, largest, preview, stable_sample,
)


def test_ranks_with_ties(spark):
    df = spark.sql("select * from values ('s','a',5D),('s','b',5D),('s','c',4D),('t','a',null) as t(s,c,v)")
    gaps = {r.c: r.r for r in rank_groups(df, ["s"], "v", "r").where("s='s'").collect()}
    dense = {r.c: r.r for r in rank_groups(df, ["s"], "v", "r", "dense_rank").where("s='s'").collect()}
    assert gaps == {"a": 1, "b": 1, "c": 3} and dense == {"a": 1, "b": 1, "c": 2}
    assert rank_groups(df, ["s"], "v", "r", top=1).count() == 3


def test_share_of_parent_adds_up(spark):
    df = spark.sql("select * from values ('x','hi'),('x','lo'),('x','lo'),('y','lo') as t(p,c)")
    assert rows(share_of_parent(df, ["p"], ["c"], "n", "pct")) == [
        ("x", "hi", 1, 33.33), ("x", "lo", 2, 66.67), ("y", "lo", 1, 100.0)]


def test_crosstab_and_wide_tables_lose_no_label(spark):
    df = spark.sql(
        "select * from values ('a','Low',1D),('a','Extreme',3D),('a','Extreme',5D),('b','Extreme',9D),('b',null,7D) as t(r,c,v)"
    )
    cells = crosstab(df, "r", "c")
    assert rows(cells) == [("a", "Extreme", 2, 66.67), ("a", "Low", 1, 33.33), ("b", "Extreme", 1, 100.0)]
    wide = widen(cells, "r", "c", "percent", ["Low", "Mid", "Extreme"], fill=0.0)
    assert wide.columns == ["r", "low", "mid", "extreme"]
    assert rows(wide) == [("a", 33.33, 0.0, 66.67), ("b", 0.0, 0.0, 100.0)]
    means = means_by(df, ["r", "c"], {"v": "v"})
    found = widen(means, "r", "c", "v")
    assert found.columns == ["r", "extreme", "low", "unknown"]
    assert rows(found) == [("a", 4.0, 1.0, None), ("b", 9.0, None, 7.0)]
    with pytest.raises(ValueError, match="without a label"):
        widen(cells, "r", "c", "percent", ["Low"])
    with pytest.raises(ValueError, match="long form"):
        widen(cells, "r", "c", "percent", most=1)


def test_means_keep_small_values(spark):
    df = spark.sql("select * from values (0.001D),(0.004D) as t(v)")
    assert df.agg(mean("v", places=6)).first()[0] == 0.0025
    exact = df.selectExpr("cast(v as decimal(9,3)) as v")
    assert exact.agg(mean("v", places=6)).first()[0] == 0.0025
    assert df.agg(mean("v", places=6, scale=2)).first()[0] == 0.0


def test_ordered_means_keep_absent_and_drop_unlisted(spark):
    df = spark.sql("select * from values ('Low',1D),('Odd',7D),('Low',2D) as t(c,v)")
    assert [tuple(r) for r in ordered_means(df, "c", ["Low", "Medium", "High"], ["v"]).orderBy("position").collect()] == [
        (1, "Low", 1.5), (2, "Medium", None), (3, "High", None)]


def test_contrast(spark):
    df = spark.sql("select * from values ('Yes',40D),('no',80D),(null,7D),('NO',120D) as t(f,v)")
    assert rows(contrast(df, "f", ["v"])) == [("v", 100.0, 40.0, -60.0, -60.0)]


def test_fixed_bins_close_on_the_right(spark):
    df = spark.sql("select * from values (0D,1D),(10D,2D),(10.5D,4D),(20D,6D),(99D,8D),(null,5D) as t(x,v)")
    got = fixed_bins(df, "x", [0, 10, 20, 30], ["a", "b", "c"], "v", "bin", "m").orderBy("position")
    assert [tuple(r) for r in got.collect()] == [(1, "a", 2.0), (2, "b", 5.0), (3, "c", None)]


def test_quantile_trend_merges_equal_edges(spark):
    df = spark.sql(
        "select 'same' as g, 5D as x, 1D as v from range(4) union all"
        " select 'flat', case when id < 8 then 1D else cast(id as double) end, cast(id as double) from range(10)"
        " union all select 'spread', cast(id as double), cast(id as double) from range(11)"
    )
    got = [tuple(r) for r in quantile_trend(df, "g", "x", "v", "m").orderBy("g", "bin").collect()]
    assert [r[:2] + r[5:] for r in got] == [
        ("flat", 1, 8, 3.5), ("flat", 2, 2, 8.5), ("same", 1, 4, 1.0),
        ("spread", 1, 3, 1.0), ("spread", 2, 2, 3.5), ("spread", 3, 2, 5.5),
        ("spread", 4, 2, 7.5), ("spread", 5, 2, 9.5)]
    assert got[2][2:5] == (5.0, 5.0, 5.0)  # one value: one bin
    assert got[3][2:5] == (0.0, 2.0, 1.0)
    sketch = quantile_trend(df, "g", "x", "v", "m", exact=False)
    assert sketch.agg(F.sum("rows_in_bin")).first()[0] == 25


def test_correlations_handle_degenerate_input(spark):
    df = spark.sql("select cast(id as double) as a, cast(2*id as double) as b, 1D as c from range(5)")
    assert rows(correlation_matrix(df, ["a", "b", "c"])) == [("b", "a", 1.0), ("c", "a", None), ("c", "b", None)]
    assert correlations(df.limit(1), [("a", "b")]).first().r is None
    assert rows(correlation_matrix(df, ["a", "b", "c"], complete=True)) == [("b", "a", 1.0), ("c", "a", None), ("c", "b", None)]


def test_attribute_spread(spark):
    df = spark.sql("select * from values ('i','x',1),('i','x',2),('j','x',1),('j',null,1) as t(k,a,b)")
    assert rows(attribute_spread(df, "k", ["a", "b"])) == [("i", 1, 2, True), ("j", 1, 1, False)]


def test_sample_depends_only_on_keys_and_seed(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    first = rows(stable_sample(df, "k", 50, 42))
    assert len(set(first)) == 50
    assert rows(stable_sample(df.repartition(9), "k", 50, 42)) == first
    assert rows(stable_sample(df, "k", 50, 43)) != first
    assert stable_sample(df.limit(7), "k", 50, 42).count() == 7
    # the drawn rows are those with the smallest hashes of the whole input
    drawn = sorted((r.k for r in df.collect()), key=lambda k: (hashlib.md5(f"{k}:42".encode()).hexdigest(), k))
    assert {k for (k,) in first} == set(drawn[:50])


def test_largest_and_preview_break_ties(spark):
    df = spark.sql("select * from values ('b',9D),('a',9D),('c',null) as t(k,v)")
    assert [r.k for r in largest(df, "v", "k", 2).collect()] == ["a", "b"]
    assert [r.k for r in preview(df, "k", 2).collect()] == ["a", "b"]


def test_star_join_renames_collisions(spark):
    fact = spark.sql("select 'f' as id, 'S1' as code, 'Rabi' as season, 3 as rain")
    weather = spark.sql("select 'S1' as code, 'Winter' as season, 9 as sun")
    joined = star_join(fact, weather, "code", "code", "_station")
    assert joined.columns == ["code", "id", "season", "rain", "season_station", "sun"]
    other = star_join(fact.withColumnRenamed("code", "match"), weather, "match", "code", "_station")
    assert other.first().season_station == "Winter"


def test_not_in_follows_sql_null_rules(spark):
    left = spark.sql("select * from values ('a'),('b'),(null) as t(s)")
    full = spark.sql("select * from values ('a'),('a') as t(x)")
    with_null = spark.sql("select * from values ('a'),(null) as t(x)")
    for excluded in (full, with_null, full.limit(0)):
        left.createOrReplaceTempView("l")
        excluded.createOrReplaceTempView("x")
        expected = rows(spark.sql("select s from l where s not in (select x from x)"))
        assert rows(not_in(left, "s", excluded)) == expected


def test_orphans_skip_null_keys(spark):
    fact = spark.sql("select * from values ('a'),('z'),(null) as t(k)")
    assert rows(orphans(fact, "k", spark.sql("select 'a' as id"), "id")) == [("z",)]
