from fieldlake.llm import licenses
from helpers import SCHEMA, no_documents, odd_documents, odd_texts, plain, prose, read


def brute(text):
    words, starts, labels = plain(text), [], set()
    for label, phrase in licenses.PHRASES:
        phrase = phrase.split()
        for k in range(len(words) - len(phrase) + 1):
            if words[k : k + len(phrase)] == phrase:
                starts.append(k)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def base(row):
    return row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels


def test_base_phrases_as_by_brute_force(spark, small_dir):
    docs = read(spark, small_dir)
    extra = spark.createDataFrame(
        [(10_000, "Under the MIT License. under the mit-license, CC BY-NC 4.0 cc by nc by nc", None, None, None),
         (10_001, "Apache License, Version 2.0 apache license version 20 apache apache license version 2", None, None, None),
         (10_002, ("cc by nc " * 5000) + "é under the mit license", None, None, None)], SCHEMA)
    docs = docs.unionByName(extra)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert len(rows) == len(texts) and sum(r.n_base > 0 for r in rows.values()) > 3
    for doc_id, row in rows.items():
        assert base(row) == brute(texts[doc_id]), doc_id
        assert set(filter(None, row.base_labels.split(","))) <= set(filter(None, row.labels.split(",")))
        assert 0 <= row.score <= 1 and (row.score == 1 or not row.n_base)


def test_edited_notices_are_found_on_neighbouring_diagonals(spark):
    label, notice = licenses.NOTICES[0]
    words = notice.split()
    put_in = " ".join(words[:6] + ["indeed"] + words[6:20] + words[21:])
    half = " ".join(words[: len(words) // 3])
    docs = spark.createDataFrame([(k, f"{prose(k, 50)} {t} {prose(k + 9, 50)}", None, None, None) for k, t in enumerate([notice, put_in, half, ""])], SCHEMA)
    rows = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert [rows[k].labels for k in range(4)] == [label, label, "", ""]
    assert rows[0].score == 1 and 0.7 <= rows[1].score < 1 and 0 < rows[2].score < 0.7 and rows[3].score == 0
    assert licenses.scan(docs, notices=[]).where("labels <> ''").count() == 0


def test_odd_rows(spark):
    got = sorted((r.doc_id is None, r.doc_id or 0, base(r)) for r in licenses.scan(odd_documents(spark)).collect())
    assert got == sorted((i is None, i or 0, brute(t)) for i, t in odd_texts())


def test_no_rows(spark):
    assert licenses.scan(no_documents(spark)).count() == 0
