"""SpotSigs fingerprints: chains of content words that follow common words. DataFrame functions only.

Every common word (anchor) opens a chain with the next two content words; at most eight common
words may stand between them. Where no anchor stands, every three content words in a row are a
signature too (`even_signatures`), so that any text has enough and a small edit changes only the
signatures around it; `signatures` instead takes all triples of a text with few anchors. The set
of signatures, hashed, is the fingerprint. Sets are compared by Jaccard similarity, and only if
their lengths allow the similarity that is asked for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlake.llm.common import Scratch

# Common words of English, German, French and Spanish.
COMMON_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that",
    "the", "this", "to", "was", "with",
    "als", "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "ist", "mit", "sich", "und", "von", "zu",
    "au", "dans", "de", "du", "est", "et", "la", "le", "les", "par", "pas", "pour", "que", "qui", "sur", "un", "une",
    "con", "del", "el", "en", "las", "lo", "los", "no", "para", "por", "se", "y",
]
_COMMON = "|".join(COMMON_WORDS)
_SKIP = f"(?:(?:{_COMMON}) ){{0,8}}+"
_SPOTS = f"(?<= )(?=((?:{_COMMON}) {_SKIP}[^ ]+ {_SKIP}[^ ]+) )"
_TRIPLES = "(?<= )(?=([^ ]+ [^ ]+ [^ ]+) )"
# Common words get a mark that no word has; a pattern by first letters tries fewer of them.
_MARK = "\x01"
_BY_LETTER = "|".join(f"{c}(?:{'|'.join(sorted(w[1:] for w in COMMON_WORDS if w[0] == c))})" for c in sorted({w[0] for w in COMMON_WORDS}))
_UNMARKED = f" (?=[a-z]{{1,{max(map(len, COMMON_WORDS))}}}+ )(?=(?:{_BY_LETTER}) )"
_SKIP_MARKED = f"(?:{_MARK}[^ ]+ ){{0,8}}+"
_CONTENT = f"[^{_MARK} ][^ ]*"
# Each word and what it opens: a chain (groups 1 to 3), a triple of content words (group 4), or nothing.
_WORD = (
    f"(?:(?=({_MARK}[^ ]+) {_SKIP_MARKED}(?:{_MARK}[^ ]+|({_CONTENT})) {_SKIP_MARKED}([^ ]+) )"
    f"|(?=({_CONTENT} {_CONTENT} {_CONTENT}) )|)[^ ]+ "
)
_OPENED, _NOTHING = "$1$4 $2 $3\n", "  "


def signatures(text: Column, least: int = 4) -> Column:
    """Sorted distinct hashes of a text's chains; of the whole text if it has fewer than three words.

    Only a text without letters and digits, or null, has no chain at all: it gives the hash of
    the text itself, an empty or null text an empty array.
    """

    def choose(p: Column) -> Column:
        spots = F.regexp_extract_all(p, F.lit(_SPOTS), F.lit(1))
        triples = F.regexp_extract_all(p, F.lit(_TRIPLES), F.lit(1))
        whole = F.when(F.trim(p) == "", text).otherwise(p)

        def by_spots(s: Column) -> Column:
            by_words = F.when(F.size(triples) > 0, F.array_sort(F.array_distinct(F.transform(triples, lambda x: F.hash(x)))))
            return F.when(F.size(s) >= least, _hashed(s)).otherwise(F.coalesce(by_words, F.array(F.hash(whole))))

        return _once(spots, by_spots)

    return _of_plain(text, choose)


def even_signatures(text: Column) -> Column:
    """Sorted distinct hashes of a text's chains and of its triples of content words, by one rule for every text.

    A text without any, of at most three content words, gives the hash of the whole text; so
    does a text without letters and digits. An empty or null text gives an empty array. One
    pass marks common words, one replaces each word by the signature that it opens.
    """

    def choose(p: Column) -> Column:
        whole = F.when(F.trim(p) == "", text).otherwise(p)
        marked = F.ltrim(F.regexp_replace(p, _UNMARKED, f" {_MARK}"))
        opened = F.split(F.regexp_replace(marked, _WORD, _OPENED), "\n")
        none = F.array(F.xxhash64(F.lit(_NOTHING)), F.xxhash64(F.lit("")))
        found = F.array_except(F.transform(opened, lambda x: F.xxhash64(x)), none)
        return _once(found, lambda s: F.when(F.size(s) > 0, F.sort_array(s)).otherwise(F.array(F.xxhash64(whole))))

    return _of_plain(text, choose, "bigint")


def _hashed(chains: Column) -> Column:
    """Sorted distinct hashes; common words but the first and the last of a chain are no part of it."""
    drop = rf"(?<= )(?:(?:{_COMMON}) )+"
    return F.array_sort(F.array_distinct(F.transform(chains, lambda x: F.hash(F.regexp_replace(x, F.lit(drop), F.lit(""))))))


def _of_plain(text: Column, choose, kind: str = "int") -> Column:
    """`choose` of the text's words, each between single spaces; an empty array for an empty or null text."""
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    empty = F.coalesce(F.length(text), F.lit(0)) == 0
    return F.when(empty, F.array().cast(f"array<{kind}>")).otherwise(_once(plain, choose))


def _once(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fingerprint(sigs: Column, digits: int = 8) -> Column:
    """All hashes in hexadecimal, `digits` of each: 8 for 32 bits, 16 for 64."""
    return F.array_join(F.transform(sigs, lambda x: F.right(F.lpad(F.hex(x.cast("long")), F.lit(16), F.lit("0")), F.lit(digits))), "")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 0 without a comparison if the lengths rule `least` out. Empty sets are alike."""
    low, high = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    exact = both / (F.size(a) + F.size(b) - both)
    return (
        F.when(high == 0, F.lit(1.0))
        .when((low == 0) | (low < F.lit(least) * high), F.lit(0.0))
        .otherwise(exact)
        .cast("double")
    )


def in_order(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Distinct (doc_id, hash of the text), each with the row before it: its id, hash, a quarter of its length, how many have it.

    The order is ascending by id, null first, then by hash; before the first stands the last.
    Rows are ordered within ranges; one row per range carries over its end.
    """
    thin = docs.select("doc_id", F.xxhash64("text").alias("_h"), F.coalesce(F.length("text"), F.lit(0)).alias("_chars"))
    each = thin.groupBy("doc_id", "_h", "_chars").agg(F.count("*").alias("_n"))
    ranged = each.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h")
    ranged = scratch.put(ranged.withColumn("_part", F.spark_partition_id()), "order")
    within = Window.partitionBy("_part").orderBy("doc_id", "_h")
    row = F.struct("doc_id", "_h", F.floor(F.col("_chars") / 4).cast("int").alias("_quarter"), "_n")
    ends = ranged.withColumn("_row", row).groupBy("_part").agg(F.max_by("_row", F.struct(F.col("doc_id").isNotNull(), "doc_id", "_h")).alias("_end"))
    by_part = Window.orderBy("_part")
    everything = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("_end").over(by_part), F.last("_end").over(everything))
    ends = scratch.put(ends.select("_part", before.alias("_end")), "ends")
    placed = ranged.withColumn("_before", F.lag(row).over(within)).join(ends, "_part")
    return placed.select("doc_id", "_h", F.coalesce("_before", "_end").alias("_before"))


def _key(doc_id: str, text_hash: str) -> list[Column]:
    """Columns that are equal for equal ids, null or not, and equal texts."""
    return [F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"), F.col(doc_id).isNull().alias("_none"), F.col(text_hash).alias("_h")]


def fingerprints(docs: DataFrame, signatures: Callable[[Column], Column] = signatures) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last quarter replaced by the first as many characters, or all, of
    the next document's; documents follow each other by id (null first, equal ids by a hash of
    the text), and the first follows the last. Rows with equal id and text are one document in
    that order and get equal results. Null text counts as empty, whose fingerprint is empty.
    Other columns are ignored. `signatures` is the rule, this module's or another.

    Rows with equal id and text are worked on once and counted, so many of them are no hot key.
    Two shuffles carry texts; signatures are made where they are compared and never move.
    """
    scratch = Scratch(docs.sparkSession, "spotsigs")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = in_order(docs, scratch).select(*_key("doc_id", "_h"), "_before")
    key = ["_id", "_none", "_h"]
    each = docs.withColumn("_h", F.xxhash64("text")).select(*_key("doc_id", "_h"), "text")
    each = each.groupBy(*key).agg(F.first("text").alias("text"))
    gives = each.join(order, key).select(*_key("_before.doc_id", "_before._h"), F.col("_before").alias("_own"), F.col("text").alias("_next"))
    met = each.join(gives, key)
    kept, head = F.expr("left(text, cast(length(text) as int) - _own._quarter)"), F.expr("left(_next, _own._quarter)")
    met = met.withColumn("_edited", F.concat(kept, head))
    for name, column in (("_sigs", "text"), ("_edited_sigs", "_edited"), ("_next_sigs", "_next")):
        met = met.withColumn(name, signatures(F.col(column)))
    digits = 8 if met.schema["_sigs"].dataType.elementType.typeName() == "integer" else 16
    found = met.select(
        F.col("_own.doc_id").alias("doc_id"), F.length("text").cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"), fingerprint(F.col("_sigs"), digits).alias("fingerprint"),
        fingerprint(F.col("_edited_sigs"), digits).alias("edited_fingerprint"),
        likeness(F.col("_sigs"), F.col("_edited_sigs")).alias("near_edited"),
        likeness(F.col("_sigs"), F.col("_next_sigs")).alias("near_next"), F.col("_own._n").alias("_n"),
    )
    return found.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).drop("_n", "_again")


def near_pairs(docs: DataFrame, least: float = 0.75, signatures: Callable[[Column], Column] = signatures) -> DataFrame:
    """Pairs (a, b, likeness) of distinct signature sets that are alike, named by their smallest doc_id.

    Sets are divided by length so that only equal or neighbouring divisions can reach `least`;
    within them two sets meet if they share one of their rarest signatures. Equal sets are one;
    sets of null ids only and empty sets are left out.
    """
    scratch = Scratch(docs.sparkSession, "spotsigs")
    sets = docs.where(F.col("doc_id").isNotNull()).select("doc_id", signatures(F.col("text")).alias("sigs"))
    sets = scratch.put(sets.where(F.size("sigs") > 0).groupBy("sigs").agg(F.min("doc_id").alias("id")), "sets")
    each = sets.select("id", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    counts = each.groupBy("sig").agg(F.count("*").alias("df")).where(F.col("df") > 1)
    rank = F.row_number().over(Window.partitionBy("id").orderBy("df", "sig"))
    alone = F.col("n") - F.count("*").over(Window.partitionBy("id"))
    # Signatures of one set only come first in the order and meet nothing.
    placed = each.join(counts, "sig").withColumn("at", rank + alone)
    short = placed.where(F.col("at") <= F.col("n") - F.ceil(F.lit(least) * F.col("n")) + 1)
    division = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / least))).cast("int")
    short = scratch.put(short.select("id", "n", "sig", division.alias("part")), "short")
    asked = short.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") + 1)))
    x, y = asked.alias("x"), short.alias("y")
    met = x.join(y, ["sig", "part"]).where(
        ((F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.id") < F.col("y.id"))))
        & (F.col("x.n") >= F.col("y.n") * least)
    )
    pairs = met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    first = sets.select(F.col("id").alias("a"), F.col("sigs").alias("_a"))
    second = sets.select(F.col("id").alias("b"), F.col("sigs").alias("_b"))
    alike = pairs.join(first, "a").join(second, "b").withColumn("likeness", likeness(F.col("_a"), F.col("_b"), least))
    return alike.where(F.col("likeness") >= least).select("a", "b", "likeness")
