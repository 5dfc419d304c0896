import duckdb
import pytest

from fieldlake.llm import mixing
from helpers import SCHEMA, no_documents, odd_documents, odd_texts, read, spaced


def test_same_mix_as_sql(spark, small_dir):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small_dir}/{name}.parquet'")
    expected = sorted(con.execute(mixing.MIX_SQL).fetchall())
    mixed = mixing.mix(read(spark, small_dir).repartition(5), read(spark, small_dir, "labels"))
    got = sorted(tuple(r) for r in mixed.select("doc_id", "size", "source_size", "target", "taken").collect())
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in expected]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in expected])


@pytest.mark.parametrize("sizes", [[100, 100, 100, 100], [1000, 1, 1, 1], [0, 0, 5], [7], [0]])
def test_targets_share_out_the_excess(spark, sizes):
    frame = spark.createDataFrame([(chr(97 + k), n) for k, n in enumerate(sizes)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    target, left, free = {}, 1.5 * sum(sizes), dict(enumerate(sizes))
    while free:
        weights = {k: (3, 1, 2)[k % 3] for k in free}
        over = {k for k in free if left * weights[k] / sum(weights.values()) > 2 * sizes[k]}
        for k in over or free:
            target[k] = 2 * sizes[k] if over else left * weights[k] / sum(weights.values())
        left -= sum(target[k] for k in over)
        free = {k: n for k, n in free.items() if k in over} and {k: n for k, n in free.items() if k not in over} if over else {}
    assert got == pytest.approx({chr(97 + k): t for k, t in target.items()})


def test_taken_words_come_near_the_target_whatever_the_bins(spark, small_dir):
    docs = read(spark, small_dir)
    runs = [sorted(tuple(r) for r in mixing.mix(docs.repartition(n), bins=b).collect()) for n, b in ((1, 4096), (6, 4096), (3, 1), (3, 7))]
    assert runs[0] == runs[1]
    by_source = {}
    for doc_id, source, size, source_size, target, copies, taken in runs[0]:
        assert taken == copies * size and copies <= 2
        by_source.setdefault(source, [0, target, 0])
        by_source[source][0] += taken
        by_source[source][2] = max(by_source[source][2], size)
    assert all(abs(got - target) <= most for got, target, most in by_source.values())
    assert [r[:2] + r[5:] for r in runs[2]] == [r[:2] + r[5:] for r in runs[0]] == [r[:2] + r[5:] for r in runs[3]]


def test_quality_raises_the_chance(spark):
    docs = spark.createDataFrame([(k, "w " * 10, None, "a", 20) for k in range(400)] + [(k, "w " * 40, None, "b", 80) for k in range(400, 440)], SCHEMA)
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, quality int")
    rows = mixing.mix(docs, labels, share=0.5, weights=(1, 1)).where("source = 'a' and copies > 0").collect()
    good = sum(r.doc_id % 2 for r in rows)
    assert good > 2 * (len(rows) - good)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    mixed = mixing.mix(docs).collect()
    assert sorted(r["size"] for r in mixed) == sorted(len(spaced(t)) for _, t in odd_texts())
    taken = mixing.take(docs)
    assert taken.schema.simpleString() == docs.schema.simpleString()
    assert sum(len(spaced(r.text)) for r in taken.collect()) == sum(r.taken for r in mixed)


def test_no_rows(spark):
    docs = no_documents(spark)
    assert mixing.mix(docs).count() == 0 and mixing.take(docs).count() == 0
