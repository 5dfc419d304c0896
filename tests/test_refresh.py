import shutil
import time

from fieldlake.contracts import Contract
from fieldlake.streaming.refresh import land, landed, refresh_stream

from conftest import rows

TINY = Contract("tiny", "id STRING NOT NULL, v INT", key=("id",))


def test_new_files_refresh_and_repeats_change_nothing(spark, tmp_path):
    raw, landing, checkpoint = (tmp_path / n for n in ("raw", "landing", "ck"))
    raw.mkdir()
    batches = []

    def handle(batch, batch_id):
        land(batch, batch_id, str(landing))
        batches.append(batch_id)

    def refresh():
        query = refresh_stream(spark, str(raw), TINY, str(checkpoint), handle)
        query.awaitTermination(120)
        return rows(landed(spark, str(landing), TINY))

    (raw / "one.csv").write_text("id,v\na,1\nb,1\n")
    (raw / "notes.txt").write_text("id,v\nz,9\n")
    assert refresh() == [("a", 1), ("b", 1)]
    done = len(batches)
    assert refresh() == [("a", 1), ("b", 1)] and len(batches) == done

    time.sleep(1.1)
    (raw / "two.csv").write_text("id,v\nb,2\nc,2\n")
    expected = [("a", 1), ("b", 2), ("c", 2)]
    assert refresh() == expected

    shutil.copyfile(raw / "two.csv", raw / "two-again.csv")
    assert refresh() == expected

    # a batch that runs twice replaces its own rows
    handle(spark.sql("select 'd' as id, 4 as v, now() as _arrived, 'f' as _file"), 99)
    handle(spark.sql("select 'd' as id, 4 as v, now() as _arrived, 'f' as _file"), 99)
    assert rows(landed(spark, str(landing), TINY)) == expected + [("d", 4)]
