"""Every stage against a plain version, each on what its predecessor kept."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from fieldlake.llm import decontaminate, mixing, queries, toxicity
from helpers import odd_documents, plain, read
from test_decontaminate import holds
from test_jaccard_join import brute as linked
from test_token_store import expected as encoded


@pytest.fixture(scope="module")
def steps(spark, small_dir, tmp_path_factory):
    folder, docs = tmp_path_factory.mktemp("stages"), read(spark, small_dir)
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], small_dir).write.parquet(f"{folder}/{name}")
        kept.append(spark.read.parquet(f"{folder}/{name}"))
    return kept


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_names_and_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_store"]
    assert all(df.columns == steps[0].columns for df in steps[:-1])


def test_toxic_documents_go(spark, small_dir, steps):
    labels = read(spark, small_dir, "labels")
    net = toxicity.fit(steps[0], labels)
    rejected = {r.doc_id for r in toxicity.score(steps[0], net).where("predicted = 1").collect()}
    assert ids(steps[1]) == sorted(set(ids(steps[0])) - rejected)


def test_one_of_each_group_stays(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    assert ids(steps[2]) == sorted({c for _, _, c in linked(rows)})


def test_leaks_go_and_clean_documents_stay(spark, small_dir, steps):
    items = [plain(r.text) for r in read(spark, small_dir, "benchmark").collect()]
    texts = {r.doc_id: plain(r.text) for r in steps[2].collect()}
    leaking = {d for d, words in texts.items() if any(holds(words, i) for i in items)}
    gone = set(texts) - set(ids(steps[3]))
    assert leaking and len(gone & leaking) >= 0.9 * len(leaking)
    found = {r.doc_id for r in decontaminate.leaks(steps[2], read(spark, small_dir, "benchmark")).collect()}
    assert gone == found


def test_documents_repeat_as_the_mix_says(spark, small_dir, steps):
    mixed = mixing.mix(steps[3], read(spark, small_dir, "labels")).collect()
    expected = sorted(r.doc_id for r in mixed for _ in range(r.copies))
    assert ids(steps[4]) == expected and len(set(expected)) < len(expected)


def test_ids_of_the_mix(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = sorted((r.doc_id, r.text) for r in steps[4].collect())
    assert sorted(tuple(r) for r in steps[5].collect()) == encoded(tokenizer, rows)


def test_run_is_the_stages(spark, small_dir, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, small_dir).collect())) == sorted(map(tuple, steps[5].collect()))


def test_odd_documents_pass_through(spark, small_dir):
    docs = odd_documents(spark).select(*corpus_pipeline.DOCUMENT_COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small_dir)
    assert docs.count() > 0


def test_every_operator_is_registered_once():
    names = [n.split("_")[0] for n in queries.QUERIES if n != "pipeline"]
    assert sorted(names) == sorted(f"op{k}" for k in range(1, 11)) and "pipeline" in queries.QUERIES
    assert set(queries.ORACLE) <= set(queries.QUERIES)
