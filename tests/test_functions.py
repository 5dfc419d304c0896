import datetime as dt

from pyspark.sql import functions as F

from fieldlake.functions import half_away, is_yes, mean, parse_dates, rate, same_text, upper_columns


def one(df):
    return tuple(df.collect()[0])


def test_mean_is_exact_at_half_way(spark):
    df = spark.sql("select * from values (1.00D), (1.01D) as t(x)")
    # 1.005 exactly: doubles would give 1.0
    assert one(df.agg(mean("x"))) == (1.01,)
    assert one(df.agg(mean(-F.col("x")))) == (-1.01,)


def test_mean_ignores_nulls_and_is_null_for_nothing(spark):
    df = spark.sql("select * from values (1.0D), (null), (2.0D) as t(x)")
    assert one(df.agg(mean("x"))) == (1.5,)
    assert one(df.where("x > 9").agg(mean("x"))) == (None,)


def test_rate_denominators(spark):
    df = spark.sql("select * from values ('Yes'), ('NO'), ('yes'), (null) as t(p)")
    no = same_text("p", "No")
    assert one(df.agg(rate(is_yes("p")), rate(is_yes("p"), among=is_yes("p") | no))) == (50.0, 66.67)
    assert one(df.where("p = 'x'").agg(rate(is_yes("p")))) == (None,)


def test_flags_ignore_case(spark):
    df = spark.sql("select * from values ('YES'), ('Yes'), ('no'), (null) as t(p)")
    assert [r[0] for r in df.select(is_yes("p")).collect()] == [True, True, False, False]


def test_half_away(spark):
    df = spark.sql("select * from values (2.5D), (-2.5D), (0.0D) as t(x)")
    assert [r[0] for r in df.select(half_away(F.col("x"), 0)).collect()] == [3.0, -3.0, 0.0]


def test_bad_dates_become_null(spark):
    df = spark.sql("select '2020-02-29' as a, '2020-02-30' as b, 'soon' as c, cast(null as string) as d")
    parsed = parse_dates(df, ["a", "b", "c", "d"])
    assert [t for _, t in parsed.dtypes] == ["date"] * 4
    assert one(parsed) == (dt.date(2020, 2, 29), None, None, None)


def test_upper_columns_keeps_blanks_unless_asked(spark):
    df = spark.sql("select ' goa ' as s, 'x' as t")
    assert one(upper_columns(df, ["s"])) == (" GOA ", "x")
    assert one(upper_columns(df, ["s"], trim=True)) == ("GOA", "x")
