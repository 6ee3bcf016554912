"""The registered queries and the pipeline on the smallest tables."""

import zlib
from collections import Counter

import duckdb
import pytest
from oracle_compare import connect, difference, spark_rows, sql_rows

import corpus_pipeline
from pixelproof.llm import pii, toxicity
from pixelproof.llm.queries import PII_KEY, REGISTRY, fold
from pixelproof.llm.sql import SQL
from pixelproof.llm.text import shingles
from test_pairs import expected_groups

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = connect(SF_DIR)
    return {n: con.execute(f"SELECT * FROM {n}").fetchall() for n in ("documents", "labels", "embeddings", "pages")}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_answer_as_sql(spark, name):
    names, ours = spark_rows(REGISTRY[name](spark, SF_DIR))
    expected_names, expected = sql_rows(connect(SF_DIR), SQL[name])
    assert names == expected_names
    assert ours == expected, difference(ours, expected)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))


@pytest.mark.parametrize("name, folds, held", [("op1_quality", 4, 2), ("op8_toxicity", 3, 1)])
def test_classifiers_score_every_document(spark, tables, name, folds, held):
    rows = REGISTRY[name](spark, SF_DIR).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d[0] for d in tables["documents"])
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


@pytest.mark.parametrize("name, label, least", [("op1_quality", "quality", 0.95), ("op8_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{folder}/labels.parquet'").fetchall())
    rows = [r for r in REGISTRY[name](spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in rows) >= least * len(rows) > 0


def test_groups_of_documents(spark, tables):
    _, expected = expected_groups([(d[0], d[1]) for d in tables["documents"]])
    found = REGISTRY["op10_ngram_join"](spark, SF_DIR).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == expected


def test_pipeline_keeps_to_each_stage(spark, tables):
    """Every stage against brute force on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    civil = stages[0](spark, docs, SF_DIR).cache()
    model = toxicity.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet").where(fold(3) != 1))
    score = toxicity.scorer(docs, model)
    rejected = {r[0] for r in docs.where(score("text") >= 0.7).select("doc_id").collect()}
    assert {r["doc_id"] for r in civil.collect()} == {d[0] for d in tables["documents"]} - rejected

    one = stages[1](spark, civil, SF_DIR).cache()
    _, groups = expected_groups([(r["doc_id"], r["text"]) for r in civil.collect()])
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(set(groups.values()))

    hidden = stages[2](spark, one, SF_DIR).cache()
    assert hidden.count() == one.count() and hidden.columns == docs.columns
    before = {r["doc_id"]: r["text"] for r in one.collect()}
    for r in hidden.collect():
        assert r["n_chars"] == len(r["text"])
        for m in pii.mentions(before[r["doc_id"]]):
            assert before[r["doc_id"]][m.start : m.end] not in r["text"]
        assert pii.mentions(before[r["doc_id"]]) or r["text"] == before[r["doc_id"]]

    mixed = stages[3](spark, hidden, SF_DIR).cache()
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in hidden.collect()}
    encoded = stages[4](spark, mixed, SF_DIR).collect()
    assert len(encoded) == mixed.count() and all(r["lossless"] and r["n_tokens"] == len(r["ids"]) for r in encoded)


def test_stages_on_awkward_tables(spark, awkward, empty, labels, tmp_path):
    labels([(4, 1, 0), (6, 1, 1)]).write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (awkward, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path)).cache()
            assert docs.count() >= 0
    kept = corpus_pipeline.STAGES[1][1](spark, awkward, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in kept)[5] == 1 and not any(r["doc_id"] == 6 for r in kept)
    assert {1, 2, 3} <= {r["doc_id"] for r in kept}


def test_surrogates_do_not_depend_on_the_partitions(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    one = {r["doc_id"]: r["text"] for r in pii.with_surrogates(docs.coalesce(1), PII_KEY).collect()}
    many = {r["doc_id"]: r["text"] for r in pii.with_surrogates(docs.repartition(7), PII_KEY).collect()}
    assert one == many and len(shingles(one[0]))
