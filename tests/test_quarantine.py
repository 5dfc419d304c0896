import pytest

from conftest import rows
from fieldlake.contracts import Contract
from fieldlake.plans import pipeline
from fieldlake.sinks.publish import current
from fieldlake.sources.derived import derive_feed
from fieldlake.sources.feeds import FEED_FILES, RejectedRows, read_feed, read_with_quarantine
from fieldlake.sources.tables import load_tables

TINY = Contract("tiny", "id STRING NOT NULL, size INT, rate DOUBLE, name STRING", key=("id",))
HEAD = "id,size,rate,name\n"


def split(spark, path, most=100):
    good, bad = read_with_quarantine(spark, str(path), TINY, most)
    return rows(good), sorted((r.feed, r.file.rpartition("/")[2], r.line, r.reason) for r in bad.collect())


def test_bad_lines_do_not_stop_a_feed(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEAD + "1,5,0.5,x\n2,many,0.5,y\n3,,,\n4,7,1e3,\"a, b\"\n5,6,half,z\n")
    (tmp_path / "b.csv").write_text(HEAD + "6,1\n,2,0.5,nobody\n7,1,2,x,more\n8,x,y,z\n9,99999999999,1,big\n")
    good, bad = split(spark, tmp_path)
    assert good == [("1", 5, 0.5, "x"), ("3", None, None, None), ("4", 7, 1000.0, "a, b")]
    assert bad == [
        ("tiny", "a.csv", "2,many,0.5,y", "size is no int: many"),
        ("tiny", "a.csv", "5,6,half,z", "rate is no double: half"),
        ("tiny", "b.csv", ",2,0.5,nobody", "id is empty"),
        ("tiny", "b.csv", "6,1", "the line does not have the declared cells"),
        ("tiny", "b.csv", "7,1,2,x,more", "too many cells"),
        ("tiny", "b.csv", "8,x,y,z", "size is no int: x; rate is no double: y"),
        ("tiny", "b.csv", "9,99999999999,1,big", "size is no int: 99999999999"),
    ]
    assert len(good) + len(bad) == 10


def test_limits(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(HEAD + "".join(f"{i},{'x' if i % 10 == 0 else i},1,n\n" for i in range(40)))
    for most in (4, 0.1, 1000):
        good, bad = split(spark, path, most)
        assert len(good) == 36 and len(bad) == 4
    for most in (0, 3, 0.09):
        with pytest.raises(RejectedRows, match="4 of 40 lines rejected.*size is no int: x"):
            split(spark, path, most)
    path.write_text(HEAD)
    assert split(spark, path, 0) == ([], [])


def test_a_clean_feed_is_the_strict_feed_and_a_wrong_header_an_error(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(HEAD + "1,5,0.5,x\n2,6,,\"q \"\"r\"\"\"\n")
    good, bad = split(spark, path, 0)
    assert good == rows(read_feed(spark, str(path), TINY)) and bad == []
    path.write_text("id,rate,size,name\n1,1,1,x\n")
    with pytest.raises(Exception, match="Expected: size but found: rate"):
        split(spark, path)


def test_a_run_with_quarantine(spark, small_dir, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    for name, file in FEED_FILES.items():
        derive_feed(spark, small_dir, name).coalesce(1).write.option("header", True).csv(f"{tmp_path}/{file}")
        part = next((tmp_path / file).glob("part-*.csv"))
        (raw / file).write_bytes(part.read_bytes())
    farms = raw / FEED_FILES["feed_farms"]
    farms.write_text(farms.read_text().rstrip("\n") + "\nbroken,line\n")
    with pytest.raises(Exception, match="MALFORMED|column|length"):
        pipeline.run(spark, str(raw), target)
    counts = pipeline.run(spark, str(raw), target, quarantine=f"{tmp_path}/rejected")
    assert counts == {"feed_farms": 1515, "feed_stations": 12, "feed_climate": 1010}
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/rejected").select("feed", "line").collect()] == [("feed_farms", "broken,line")]
    assert load_tables(spark, current(spark, target))["dim_farms"].count() == 1500
    with pytest.raises(RejectedRows):
        pipeline.run(spark, str(raw), target, quarantine=f"{tmp_path}/rejected", most_rejected=0)
