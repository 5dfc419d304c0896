import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldlake.llm import language
from helpers import no_documents, odd_documents, read


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=25), st.lists(st.integers(0, 2), max_size=6))
def test_automaton_accepts_exactly_the_substrings(sequence, asked):
    steps, at = language.suffix_automaton(np.array(sequence, dtype=np.int64), 3), 0
    for symbol in asked:
        at = steps[at, symbol] if at >= 0 else -1
    inside = any(sequence[k : k + len(asked)] == asked for k in range(len(sequence) - len(asked) + 1))
    assert (at >= 0) == inside


def greedy(reference, text):
    """Phrases of a text: the longest parts that occur in the reference, unknown characters alone."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in reference:
            end += 1
        at = max(end - 1, at + 1)
        count += 1
    return count


def test_phrases_as_by_brute_force():
    texts = {"aa": ["hello there my good friend"], "bb": ["wer reitet so spaet durch nacht und wind"]}
    parser = language.parser_of(texts)
    for text in ("hello my wind", "nacht und good", "xyz qq hello", "wer"):
        total, letters = parser.rates(language.pa.array([text]))
        clean = "".join(c if c.isalpha() else " " for c in text)
        known = {c for x in texts.values() for c in x[0]}
        own = "".join(c if c in known or c == " " else "\0" for c in clean)
        expected = [greedy(texts[x][0], own) for x in parser.languages]
        got = total[0] / parser.scale
        assert letters[0] and np.all(np.abs(got - expected) <= 2), (text, got, expected)


def test_held_out_accuracy(spark, small_dir):
    docs = read(spark, small_dir)
    parser = language.fit(docs)
    found = {r.doc_id: r for r in language.identify(docs, parser).collect()}
    held = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and r.lang]
    assert len(held) > 40
    assert np.mean([found[r.doc_id].lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found.values())
    again = {r.doc_id: r for r in language.identify(docs.repartition(7), language.fit(docs.repartition(3))).collect()}
    assert again == found


def test_a_text_counts_whole_and_alone(spark, small_dir):
    docs = read(spark, small_dir)
    parser = language.fit(docs)
    texts = [r.text for r in docs.limit(30).collect()]
    together, _ = parser.rates(language.pa.array(texts))
    alone = np.stack([parser.rates(language.pa.array([t]))[0][0] for t in texts])
    assert np.array_equal(together, alone)
    longer, _ = parser.rates(language.pa.array([texts[0] * 50]))
    assert (longer[0] > 30 * together[0]).all()


def test_odd_rows(spark, small_dir):
    parser = language.fit(read(spark, small_dir))
    rows = language.identify(odd_documents(spark), parser).collect()
    assert len(rows) == odd_documents(spark).count()
    assert {r.lang_pred for r in rows if r.doc_id in (4, 5, 6)} == {"und"}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und") and any(r.lang_pred != "und" for r in rows)


@pytest.mark.parametrize("labels", [[], ["en"]])
def test_no_rows_and_few_languages(spark, labels):
    parser = language.fit(no_documents(spark)) if not labels else language.parser_of({"en": ["hello"]})
    assert language.identify(no_documents(spark), parser).count() == 0
    found = {r.lang_pred for r in language.identify(odd_documents(spark), parser).collect()}
    assert found == {"und", *labels}


def test_learning_texts_are_bounded(spark, monkeypatch):
    """A language of one text of 10 MB, one of many copies of a row, and whole short texts within the bound."""
    seen = {}
    monkeypatch.setattr(language, "parser_of", lambda texts: seen.update(texts))
    ids = [k for k in range(90) if zlib.crc32(str(k).encode()) % 3 != 1]
    rows = [(ids[0], "long " * 2_000_000, "aa"), *[(ids[1], "one row", "bb")] * 50, (ids[2], "other row", "bb")]
    rows += [(k, f"text {k} " + "w" * 90, "cc") for k in ids[3:40]]
    rows += [(None, "no id", "dd"), (ids[41], None, "cc"), (ids[42], "no lang", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language.fit(docs, most=1000)
    assert 900 <= len(seen["aa"][0]) <= 1100 and len(seen["aa"]) == 1
    assert sorted(seen["bb"]) == ["one row", "other row"]
    assert 0 < sum(map(len, seen["cc"])) <= 1000 and set(seen["cc"]) <= {r[1] for r in rows}
    if zlib.crc32(b"null") % 3 != 1:
        assert seen["dd"] == ["no id"]


def test_languages_of_many_letters_are_told_apart():
    """Letters beyond the most frequent ones, and above U+FFFF, are symbols of their own."""
    alphabets = {
        "el": range(0x3B1, 0x3C9), "ja": range(0x3041, 0x3090), "ko": range(0xAC00, 0xAE00), "ru": range(0x430, 0x450),
        "zh": range(0x4E00, 0x5200), "old": range(0x10400, 0x10428),
    }

    def text(name, seed):
        rng = np.random.default_rng(seed)
        points = list(alphabets[name])
        words = ["".join(chr(points[i]) for i in np.random.default_rng(k).integers(len(points), size=4)) for k in range(60)]
        return " ".join(words[i] for i in rng.integers(60, size=200))

    parser = language.parser_of({x: [text(x, 1)] for x in alphabets} | {"en": ["the quick brown fox jumps over lazy dogs " * 9]})
    for name in alphabets:
        assert parser.predict(language.pa.array([text(name, 2)]))[0] == [name]


def test_learns_from_whole_documents_of_every_language():
    rng = np.random.default_rng(4)
    texts = {f"l{k:02}": ["".join("abcdefghij "[i] for i in rng.integers(11, size=30_000))] for k in range(12)}
    parser = language.parser_of(texts)
    for name, (own,) in texts.items():
        # The end of each text is known as well as its beginning.
        assert parser.predict(language.pa.array([own[-400:].strip()]))[0] == [name]
