import hashlib

import pytest
import regex
from pyspark.sql import functions as F

from fieldlake.llm import queries, spotsigs
from helpers import SCHEMA, no_documents, odd_documents, odd_texts, prose, read

COMMON = set(spotsigs.COMMON_WORDS)


def chains(text, least=4):
    """The signatures as strings, word by word."""
    text = text or ""
    if not text:
        return set()
    words = regex.sub(r"[^\p{L}\p{N}]+", " ", text.lower()).split()
    found, count = set(), 0
    for at, word in enumerate(words):
        if word not in COMMON:
            continue
        chain, k, content = [word], at + 1, 0
        for _ in range(2):
            skipped = 0
            while k < len(words) and words[k] in COMMON and skipped < 8:
                chain.append(words[k])
                k, skipped = k + 1, skipped + 1
            if k < len(words):
                chain.append(words[k])
                k, content = k + 1, content + 1
        if content == 2:
            count += 1
            # Common words but the first and the last are no part of the signature.
            found.add(" ".join([word, *[x for x in chain[1:-1] if x not in COMMON], chain[-1]]))
    if count >= least:
        return found
    if len(words) >= 3:
        return {" ".join(words[k : k + 3]) for k in range(len(words) - 2)}
    return {" ".join(words) if words else text}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    """Results by doc_id of documents whose ids and texts are all different."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        own = chains(text)
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), jaccard(own, chains(edited)), jaccard(own, chains(following)))
    return out


def test_fingerprints_as_by_brute_force(spark, small_dir):
    docs = read(spark, small_dir)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    expected, rows = brute(texts.items()), spotsigs.fingerprints(docs.repartition(5)).collect()
    assert len(rows) == len(expected)
    by_text = {}
    for r in rows:
        assert (r.n_chars, r.edited_sha256) == expected[r.doc_id][:2]
        assert (r.near_edited, r.near_next) == pytest.approx(expected[r.doc_id][2:])
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    alike = [r.near_edited for r in rows if r.n_chars > 400]
    assert sum(alike) / len(alike) > 0.4 > 0.05 > sum(r.near_next for r in rows) / len(rows)


def test_plan_has_no_python(spark):
    text = spotsigs.fingerprints(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_long_runs_of_common_words(spark):
    docs = spark.createDataFrame([(1, "the of " * 30_000 + "end word"), (2, "the " * 9 + "alpha beta")], "doc_id long, text string")
    got = {r.doc_id: r.n for r in docs.select("doc_id", F.size(spotsigs.signatures(F.col("text"))).alias("n")).collect()}
    assert got == {k: len(chains(t)) for k, t in ((1, "the of " * 30_000 + "end word"), (2, "the " * 9 + "alpha beta"))}


def test_odd_rows(spark):
    rows = spotsigs.fingerprints(odd_documents(spark)).collect()
    assert len(rows) == len(odd_texts())
    assert sorted(r.n_chars for r in rows) == sorted(len(t or "") for _, t in odd_texts())
    prints = {}
    for r in rows:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[4] == prints[5] == {""} and len(prints[2]) == 1 and len(prints[13]) == 2
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    one = spark.createDataFrame([(1, "the only text is this of all")], "doc_id long, text string")
    assert spotsigs.fingerprints(one).first().near_next == 1.0


def test_no_rows(spark):
    assert spotsigs.fingerprints(no_documents(spark)).count() == 0
    assert spotsigs.near_pairs(no_documents(spark)).count() == 0


def test_near_pairs_as_by_brute_force(spark):
    base = prose(3, 90).split()
    texts = []
    for k in range(30):
        words = list(base)
        words[k % 45 : k % 45 + k // 3] = [f"new{k}"]
        texts.append((k, " the ".join(words)))
    texts += [(100 + k, prose(50 + k, 60)) for k in range(20)] + [(200, texts[0][1]), (201, None), (202, "")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in texts], SCHEMA)
    sets = {}
    for i, t in texts:
        if t:
            sets.setdefault(frozenset(chains(t)), i)
    own = sorted((i, s) for s, i in sets.items())
    expected = {frozenset((a, b)) for a, x in own for b, y in own if a < b and jaccard(x, y) >= 0.75}
    got = {frozenset((r.a, r.b)) for r in spotsigs.near_pairs(docs).collect()}
    assert got == expected and expected


def even(text):
    """The signatures of the rule without a switch, word by word."""
    if not text:
        return set()
    words = regex.sub(r"[^\p{L}\p{N}]+", " ", text.lower()).split()
    triples = {" ".join(words[k : k + 3]) for k in range(len(words) - 2) if not COMMON & set(words[k : k + 3])}
    anchored = chains(text, 0) if COMMON & set(words) and len(words) > 2 else set()
    return triples | anchored or {" ".join(words) or text}


def test_query_keeps_copies_whose_anchors_cross_a_count(spark, tmp_path):
    texts = []
    for k in range(12):
        words = prose(40 + k, 240).split()
        for j in range(1 + k % 6):
            words[7 + 35 * j] = "the"
        texts.append((k, " ".join(words)))
    texts += [(100, None), (101, ""), (102, "..."), (103, "the of"), (104, "one two"), (105, "one the two")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in texts], SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = sorted(queries.op3_spotsigs(spark, str(tmp_path)).collect(), key=lambda r: r.doc_id)
    for k, r in enumerate(rows):
        text, following = texts[k][1] or "", texts[(k + 1) % len(texts)][1] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        assert r.near_edited == pytest.approx(jaccard(even(text), even(edited))), k
        assert r.near_next == pytest.approx(jaccard(even(text), even(following))), k
        assert k > 11 or r.near_edited > 0.5
