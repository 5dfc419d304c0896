from conftest import plan, rows
from fieldlake.plans import lake as lakes
from fieldlake.plans import quality
from fieldlake.plans.lake import Lake
from fieldlake.registry import QUERIES


def test_rows_are_counted_while_tables_are_stored(spark, small_dir, monkeypatch):
    derived = []
    inner = lakes.derive_feed
    monkeypatch.setattr(lakes, "derive_feed", lambda *a: derived.append(a[2]) or inner(*a))
    lake = Lake(spark, small_dir)
    lake.star()
    feeds = ["feed_farms", "feed_stations", "feed_climate"]
    assert sorted(derived) == sorted(feeds)
    ingest, stages = QUERIES["ingest_row_counts"](lake), QUERIES["stage_row_counts"](lake)
    # No feed is derived, and no table read, a second time.
    assert sorted(derived) == sorted(feeds)
    assert "Scan parquet" not in plan(ingest) + plan(stages) and "FileScan" not in plan(ingest) + plan(stages)
    assert rows(ingest) == rows(quality.row_counts({name: lake.feed(name) for name in feeds}, "feed"))
    frames = {
        "feed_farms": lake.feed("feed_farms"), "clean_farms": lake.farms, "feed_stations": lake.feed("feed_stations"),
        "clean_stations": lake.stations, "feed_climate": lake.feed("feed_climate"), **lake.star(),
    }
    assert rows(stages) == rows(quality.row_counts(frames))
    assert ingest.dtypes == [("feed", "string"), ("rows", "bigint")] and stages.columns == ["table_name", "rows"]
    lake.close()
