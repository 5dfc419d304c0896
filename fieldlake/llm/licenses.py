"""License notices in documents by diagonal voting.

Every rolling hash of k words that also stands in a template becomes a hit (document, place).
Spark joins the hits to all template places and adds them up by diagonal, the difference of
the two places: a notice that stands word for word votes for one diagonal, one with words put
in or left out for neighbouring ones, which are merged. A span is verified if enough of the
template's k-grams vote; a phrase that must stand word for word needs all of them on one
diagonal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlake.llm.common import Scratch
from fieldlake.llm.decontaminate import Vocabulary
from fieldlake.llm.words import PLAIN, grams, signed, text_words

# Phrases that must stand word for word, and their labels.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
# Sentences of well-known license notices, and labels of their own.
NOTICES = [
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files, to deal in the software without restriction"),
    ("apache-2-text", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
    ("gpl-text", "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation"),
    ("mpl-2-text", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc-text", "This work is licensed under a Creative Commons Attribution-NonCommercial"),
    ("all-rights", "all rights reserved"),
]


@dataclass
class Templates:
    """k-gram places of all templates: the table to join with, and the hashes that occur in it."""

    rows: list[tuple]
    hashes: np.ndarray

    @staticmethod
    def of(phrases: list[tuple[str, str]], notices: list[tuple[str, str]], k: int) -> "Templates":
        every = [(label, text, True) for label, text in phrases] + [(label, text, False) for label, text in notices]
        rows, hashes = [], []
        for number, (label, text, exact) in enumerate(every):
            for _, words, places in text_words(pa.array([text]), PLAIN):
                if len(words) < k:
                    raise ValueError(f"a template needs at least {k} words: {text}")
                values, _ = grams(words, places, k)
                hashes.append(values)
                rows += [
                    (int(h), place, number, label, exact, len(values)) for place, h in enumerate(signed(values).tolist())
                ]
        return Templates(rows, np.concatenate(hashes))


def _hits(docs: DataFrame, templates: Templates, k: int) -> DataFrame:
    known = Vocabulary(templates.hashes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.zeros(batch.num_rows, dtype=np.int64)
            found: list = [None] * batch.num_rows
            for first, words, places in text_words(batch.column(2), PLAIN):
                counts[first : first + len(places) - 1] = np.diff(places)
                values, starts = grams(words, places, k)
                hit = np.flatnonzero(known.features(values) >= 0)
                text = np.searchsorted(starts, hit, "right") - 1
                for t in np.unique(text):
                    if counts[first + t] >= k:
                        own = hit[text == t]
                        found[first + t] = [
                            {"place": int(p), "gram": int(g)} for p, g in zip(own - starts[t], signed(values[own]))
                        ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts), pa.array(found, _HITS)],
                names=["row", "doc_id", "n_words", "hits"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return numbered.mapInArrow(
        search, f"row long, doc_id {kind}, n_words long, hits array<struct<place:long,gram:long>>"
    )


_HITS = pa.list_(pa.struct([("place", pa.int64()), ("gram", pa.int64())]))


def spans(hits: DataFrame, templates: Templates, *, gap: int = 2) -> DataFrame:
    """Merged diagonals of each document row and template: row, label, exact, start, votes, share, places.

    `places` counts diagonals that have every k-gram of the template, `start` and `last_start`
    are the smallest and largest of those for exact phrases, and of all else; `share` is the
    share of the template's k-grams that vote.
    """
    spark = hits.sparkSession
    table = spark.createDataFrame(
        templates.rows, "gram long, at long, template int, label string, exact boolean, n_grams int"
    )
    each = hits.select("row", F.explode("hits").alias("h")).select("row", "h.place", "h.gram")
    votes = each.join(F.broadcast(table), "gram").withColumn("diagonal", F.col("place") - F.col("at"))
    key = ["row", "template", "label", "exact", "n_grams"]
    diagonals = votes.groupBy(*key, "diagonal").agg(F.count("*").alias("votes"))
    by_diagonal = Window.partitionBy("row", "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(by_diagonal) <= F.lit(gap)
    # An exact phrase is complete on one diagonal or not there, so its diagonals stay apart.
    opens = F.when(F.col("exact") | ~F.coalesce(far, F.lit(False)), 1).otherwise(0)
    grouped = diagonals.withColumn("span", F.sum(opens).over(by_diagonal))
    merged = grouped.groupBy(*key, "span").agg(
        F.min("diagonal").alias("start"), F.least(F.sum("votes"), F.col("n_grams")).alias("votes")
    )
    return merged.withColumn("share", F.col("votes") / F.col("n_grams"))


def scan(docs: DataFrame, *, k: int = 3, least: float = 0.7, gap: int = 2, phrases=None, notices=None) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are lower-cased in A-Z and made of letters, digits and all beyond ASCII. `n_base`
    counts the places of exact phrases, whose smallest and largest first word (from 0) are
    `first_word` and `last_word`, null without any. `labels` also has notices of which at
    least the share `least` votes. `score` is the largest share of any template.

    Null and empty texts: no words, empty labels, score 0. Every row, also with a null or
    repeated id, gives its own result row. Texts are scanned whole. Other columns are ignored.
    """
    templates = Templates.of(PHRASES if phrases is None else phrases, NOTICES if notices is None else notices, k)
    found = Scratch(docs.sparkSession, "licenses").put(_hits(docs, templates, k), "hits")
    own = spans(found.where(F.col("hits").isNotNull()), templates, gap=gap)
    base = F.col("exact") & (F.col("votes") == F.col("n_grams"))
    sure = base | (~F.col("exact") & (F.col("share") >= least))
    per_row = own.groupBy("row").agg(
        F.sum(F.when(base, 1).otherwise(0)).alias("_n"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(base, F.col("label")))).alias("_base"),
        F.array_sort(F.collect_set(F.when(sure, F.col("label")))).alias("_all"),
        F.max("share").alias("_share"),
    )
    return found.select("row", "doc_id", "n_words").join(per_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("_n", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce(F.array_join("_base", ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join("_all", ","), F.lit("")).alias("labels"),
        F.coalesce("_share", F.lit(0.0)).alias("score"),
    )
