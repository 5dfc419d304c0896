import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import DecimalType

from fieldlake import contracts as c


def test_declared_sizes(spark):
    assert [len(f.columns) for f in c.FEEDS.values()] == [31, 24, 31]
    assert [len(t.columns) for t in c.STAR.values()] == [10, 4, 25, 21, 31]
    assert len(c.FACT_YIELD.required()) == 23 and len(c.FACT_CLIMATE.required()) == 30


def test_shape_selects_declared_columns_in_order(spark):
    df = spark.sql("select 'x' as extra, 'D' as district, 'S' as state, 'N' as station_name, 'C' as station_code")
    assert c.shape(df, c.DIM_STATIONS).columns == c.DIM_STATIONS.columns
    with pytest.raises(c.ContractError):
        c.shape(df.drop("district"), c.DIM_STATIONS)


@pytest.mark.parametrize("suffix", ["", " NOT NULL"])
def test_columns_are_read_with_their_suffix(suffix):
    assert c.Contract("t", f"a BIGINT{suffix}", ("a",)).schema["a"].nullable is (suffix == "")


@pytest.mark.parametrize("suffix", [" not null", " NOTNULL", " NOT NULL UNIQUE", " DEFAULT 1"])
def test_unknown_suffixes_are_errors(suffix):
    with pytest.raises(c.ContractError, match="not understood"):
        c.Contract("t", f"a BIGINT{suffix}", ("a",)).schema


def test_lake_types_hold_more_than_declared(spark):
    assert c.lake_type(DecimalType(3, 1)) == DecimalType(18, 1)


def rollup(spark, **changes):
    values = {"risk_id": "1", "state": "'S'", "crop": "'C'", "exposure_flag": "'No Alert'",
              "pest_attack_rate_pct": "1.5D", "avg_crop_health_score": "2D",
              "avg_sustainability_score": "3D", **changes}
    return spark.sql("select " + ", ".join(f"{v} as {k}" for k, v in values.items()))


def test_conform_applies_declared_types(spark):
    out = c.conform(rollup(spark), c.ROLLUP_CLIMATE_RISK)
    assert dict(out.dtypes)["pest_attack_rate_pct"] == "decimal(5,2)"
    assert out.count() == 1


@pytest.mark.parametrize(
    "change",
    [
        {"exposure_flag": "'a text that is far too long'"},
        {"state": "cast(null as string)"},
        {"pest_attack_rate_pct": "1000D"},
        {"avg_crop_health_score": "cast(null as double)"},
    ],
)
def test_conform_fails_loudly(spark, change):
    with pytest.raises(PySparkException):
        c.conform(rollup(spark, **change), c.ROLLUP_CLIMATE_RISK).collect()
