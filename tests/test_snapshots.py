import datetime
import os
import shutil

import pytest

from conftest import rows
from fieldlake.contracts import Contract
from fieldlake.sinks.files import next_pointer
from fieldlake.streaming import snapshots
from fieldlake.streaming.refresh import feed_snapshot, land, landed

TINY = Contract("tiny", "id STRING NOT NULL, day STRING, v INT", key=("id", "day"))


class Feed:
    """A landing folder, its snapshot, and a copy of all that ever landed."""

    def __init__(self, spark, tmp_path, **options):
        self.spark, self.landing, self.history = spark, str(tmp_path / "landing"), str(tmp_path / "history")
        self.snapshot = feed_snapshot(spark, str(tmp_path / "snapshot"), TINY, **options)

    def deliver(self, batch_id, values, minute=None):
        at = datetime.datetime(2024, 1, 1, 0, batch_id if minute is None else minute)
        frame = self.spark.createDataFrame(
            [(*value, at, f"file{batch_id}") for value in values], f"{TINY.ddl}, _arrived TIMESTAMP, _file STRING"
        )
        land(frame, batch_id, self.landing)
        land(frame, batch_id, self.history)

    def merge(self, **options):
        return self.snapshot.merge(self.landing, **options)

    def check(self):
        found = rows(self.snapshot.rows())
        assert found == rows(landed(self.spark, self.history, TINY))
        return found


def many(first, last, v):
    return [(f"k{i}", None if i % 7 == 0 else f"d{i % 3}", v) for i in range(first, last)]


def test_a_merge_never_reads_merged_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    assert feed.merge() is None and feed.snapshot.rows().count() == 0
    feed.deliver(0, many(0, 500, 1))
    feed.deliver(1, many(400, 600, 2))
    first = feed.merge()
    assert len(feed.check()) == 600 and feed.merge() is None
    # What was merged is gone: a second reading of it would fail or lose rows.
    shutil.rmtree(f"{feed.landing}/_batch=0")
    feed.deliver(2, [("k3", "d0", 9), ("new", None, 9)])
    second = feed.merge()
    assert second != first and len(feed.check()) == 601


def test_only_touched_buckets_are_read_and_written(spark, tmp_path, monkeypatch):
    feed = Feed(spark, tmp_path, least_buckets=32)
    feed.deliver(0, many(0, 2000, 1))
    first = feed.merge()
    before = feed.snapshot.manifest().places
    assert len(before) == 32
    read = []
    inner = snapshots.KeyedSnapshot._read
    monkeypatch.setattr(snapshots.KeyedSnapshot, "_read", lambda self, m, buckets: read.append(list(buckets)) or inner(self, m, buckets))
    feed.deliver(1, [("k1", "d1", 5), ("k2", "d2", 5)])
    second = feed.merge()
    touched = {b for b, v in feed.snapshot.manifest().places.items() if v == second}
    assert 1 <= len(touched) <= 2 and read == [sorted(touched)]
    assert {b: v for b, v in feed.snapshot.manifest().places.items() if b not in touched} == {b: first for b in before if b not in touched}
    feed.check()


def test_redelivery_and_late_files_change_nothing(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.deliver(0, many(0, 50, 1), minute=10)
    feed.merge()
    feed.deliver(1, many(0, 60, 2), minute=20)
    feed.merge()
    before = feed.check()
    feed.deliver(2, many(0, 60, 2), minute=20)  # the same file again
    feed.deliver(3, many(0, 60, 7), minute=5)  # an older file arrives late
    feed.merge()
    assert feed.check() == before
    feed.deliver(3, many(0, 60, 7), minute=5)  # a batch that runs again
    feed.merge()
    assert feed.check() == before


def test_a_merge_that_stops_half_way_is_done_again(spark, tmp_path, monkeypatch):
    feed = Feed(spark, tmp_path)
    feed.deliver(0, many(0, 40, 1))
    feed.merge()
    before = rows(feed.snapshot.rows())
    feed.deliver(1, many(20, 60, 2))

    def stop(*args):
        raise OSError("stopped")

    monkeypatch.setattr(snapshots, "next_pointer", stop)
    with pytest.raises(OSError):
        feed.merge()
    assert rows(feed.snapshot.rows()) == before
    monkeypatch.setattr(snapshots, "next_pointer", next_pointer)
    assert feed.merge()
    assert len(feed.check()) == 60


def test_old_versions_and_covered_batches_go(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for batch in range(5):
        feed.deliver(batch, many(batch * 10, batch * 10 + 30, batch))
        feed.merge(keep=1)
    feed.check()
    assert feed.snapshot.drop_covered(feed.landing) == [f"_batch={b}" for b in range(4)]
    assert os.listdir(feed.landing) == ["_batch=4"]
    places = feed.snapshot.manifest().places
    folder = tmp_path / "snapshot"
    kept = {(v.name.partition("=")[2], int(b.name.partition("=")[2])) for v in folder.glob("version=*") for b in v.glob("_bucket=*")}
    assert kept == {(v, b) for b, v in places.items()}
    feed.deliver(9, many(0, 5, 99))
    feed.merge()
    feed.check()
    with pytest.raises(ValueError):
        feed.snapshot.retire(0)


def test_a_snapshot_that_has_grown_gets_more_buckets(spark, tmp_path):
    feed = Feed(spark, tmp_path, bucket_bytes=2000, least_buckets=1)
    feed.deliver(0, many(0, 5, 1))
    feed.merge()
    small = feed.snapshot.manifest().buckets
    feed.deliver(1, many(0, 20_000, 2))
    feed.merge()
    assert feed.snapshot.manifest().buckets > 4 * small
    assert len(feed.check()) == 20_000
    feed.deliver(2, [])
    feed.merge()
    assert len(feed.check()) == 20_000
