"""A corpus made ready for training: clean, one of each kind, free of benchmarks, mixed, as ids.

Every stage works on all that its predecessor kept. Stages 1 to 4 return documents; the mix
repeats a document as often as it takes it; the last stage returns where each of its
documents stands in the token store.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fieldlake.llm import decontaminate, jaccard_join, mixing, token_store, toxicity
from fieldlake.llm.common import DOCUMENT_COLUMNS, Scratch, documents, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of these documents, does not reject.

    Labels of documents that are not here teach nothing. A document with a null id cannot be
    labelled but is judged like any other, and so is a null or empty text. Columns beside those of documents go.
    """
    docs = docs.select(*DOCUMENT_COLUMNS)
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; null and empty texts are copies of nothing."""
    return jaccard_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; with an empty benchmark, or no text, all stay."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: up to twice, or not at all. Null sources are a source of their own."""
    return mixing.take(docs, table(spark, sf_dir, "labels"))


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document stands in the token store, in order of id; null and empty texts hold the end id alone."""
    return token_store.encode_and_read(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_store", store_tokens),
]

#: Trained and searching stages have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, each on the stored result of the one before; an empty table gives no rows."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
