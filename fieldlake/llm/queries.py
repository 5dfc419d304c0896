"""The operators as registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from fieldlake.llm import (
    bit_whitening, context_mixing, decontaminate, html_text, jaccard_join, language, licenses, mixing, monoid_bpe, spotsigs,
    token_alignment, token_store, toxicity,
)
from fieldlake.llm.common import documents, fold_of, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score(documents(spark, sf_dir))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.encode_and_read(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(documents(spark, sf_dir), spotsigs.even_signatures)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.identify(docs, language.fit(docs))
    return found.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held = (fold_of("doc_id", 3) == 1).alias("held_out")
    return toxicity.score(docs, net).select("doc_id", held, "score", "predicted")


def op11_monoid_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    found = monoid_bpe.decode(monoid_bpe.encode(documents(spark, sf_dir), ranks, pattern), ranks, pattern)
    return found.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op12_bit_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bit_whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.align(documents(spark, sf_dir), a, b)


QUERIES: dict[str, Query] = {
    "op1_context_mixing": op1_context_mixing,
    "op2_token_store": op2_token_store,
    "op3_spotsigs": op3_spotsigs,
    "op4_mixing": op4_mixing,
    "op5_decontaminate": op5_decontaminate,
    "op6_licenses": op6_licenses,
    "op7_language": op7_language,
    "op8_html_text": op8_html_text,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_toxicity": op10_toxicity,
    "op11_monoid_bpe": op11_monoid_bpe,
    "op12_bit_whitening": op12_bit_whitening,
    "op13_token_alignment": op13_token_alignment,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {"op4_mixing": mixing.MIX_SQL}
