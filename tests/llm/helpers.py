"""Documents with everything that is odd, and plain versions of what operators compute."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD_SCHEMA = SCHEMA + ", size long, row string, node int, _h string, word string, again int, doc string, score double"


def spaced(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def plain(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def shingles(text, n=5):
    words = spaced(text)
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def prose(seed, n):
    syllables = "ba ce di fo gu ha je ki lo mu na pe qui ro su ta ve wi xo zu".split()
    out, state = [], seed * 7919 + 17
    for _ in range(n):
        word = ""
        for _ in range(1 + state % 3):
            state = (state * 1103515245 + 12345) % (1 << 31)
            word += syllables[(state >> 8) % len(syllables)]
        out.append(word)
    return " ".join(out)


def odd_texts():
    long = prose(1, 40_000)
    return [
        (1, prose(2, 60)), (2, prose(2, 60)), (2, prose(2, 60)), (3, prose(2, 60) + " more"), (4, None), (5, ""),
        (6, " \n\t "), (7, "one two"), (8, "ONE two"), (9, long), (None, prose(3, 50)), (None, None), (None, prose(3, 50)),
        (10, "日本語 \U0001f600 éè"), (11, "x" * 70_000), (12, "a  b\n\n c "), (13, "..."), (13, "other words here"),
    ]


def odd_documents(spark):
    rows = [
        (i, t, [None, "en", "de"][k % 3], [None, "a", "b"][k % 3], None if t is None else len(t), k, "r", k, "h", "w", 1, "d", 0.5)
        for k, (i, t) in enumerate(odd_texts())
    ]
    return spark.createDataFrame(rows, ODD_SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def read(spark, folder, name="documents"):
    return spark.read.parquet(f"{folder}/{name}.parquet")
