import pytest

from conftest import plan, rows
from fieldlake.contracts import STATION_FEED, Contract
from fieldlake.sources.derived import DERIVED, derive_feed
from fieldlake.sources.feeds import counted, from_rows, profile_feed, read_feed

TINY = Contract("tiny", "id STRING NOT NULL, size INT, name STRING", key=("id",))


def write(path, text):
    path.write_text(text)
    return str(path)


def test_declared_types(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,size,name\n007,5,x\n008,,\n")
    assert rows(read_feed(spark, path, TINY)) == [("007", 5, "x"), ("008", None, None)]


def test_reordered_header_fails_when_strict(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,name,size\n1,x,5\n")
    with pytest.raises(Exception, match="Expected: size but found: name"):
        read_feed(spark, path, TINY).collect()
    assert rows(read_feed(spark, path, TINY, strict=False)) == [("1", None, "5")]


@pytest.mark.parametrize("text", ["id,size,name\n1,many,x\n", "id,size,name,more\n1,5,x,y\n"])
def test_bad_cells_and_extra_columns_fail_when_strict(spark, tmp_path, text):
    with pytest.raises(Exception, match="MALFORMED|length|column"):
        read_feed(spark, write(tmp_path / "a.csv", text), TINY).collect()


def test_column_subset_binds_by_name(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,size,name\n1,5,x\n")
    picked = read_feed(spark, path, TINY, columns=["name", "id"])
    assert rows(picked) == [("x", "1")]
    assert "size" not in plan(picked).split("ReadSchema")[1]


def test_profile_guesses_types(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,size,name\n1,5,x\n")
    assert dict(profile_feed(spark, path).dtypes)["size"] == "int"


def test_literal_rows_and_counts(spark):
    df, seen = counted(from_rows(spark, [("a", 1), ("b", 2)], "k string, v int"), "tiny")
    assert df.count() == 2 and seen.get["rows"] == 2


def test_derived_feeds_follow_their_contracts(spark, small_dir):
    for name, derived in DERIVED.items():
        feed = derive_feed(spark, small_dir, name)
        assert feed.columns == derived.contract.columns
        assert [t for _, t in feed.dtypes] == [f.dataType.simpleString() for f in derived.contract.schema]


def test_derived_feeds_repeat_rows(spark, small_dir):
    farms = derive_feed(spark, small_dir, "feed_farms")
    assert (farms.count(), farms.distinct().count()) == (1515, 1500)
    stations = derive_feed(spark, small_dir, "feed_stations")
    assert stations.select(*STATION_FEED.key).distinct().count() == 12
