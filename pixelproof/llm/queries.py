"""One query per operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, blocks, centroids, licenses, mixing, ngram_join, passages, pieces, pii, quality, topk, toxicity, tries, webpages
from .work import ready

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(folds: int) -> Column:
    """The fold of a document, by the checksum of its id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels").where(fold(3) != 1))
    score = toxicity.scorer(documents, model)
    return documents.select("doc_id", (fold(3) == 1).alias("held_out"), score("text").alias("score")).withColumn(
        "predicted", toxicity.predicted(F.col("score"))
    )


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.measure(table(spark, sf_dir, "documents")).rows
    known = (
        table(spark, sf_dir, "labels")
        .where(fold(4) != 2)
        .groupBy("doc_id")
        .agg(F.max("quality").alias("label"))
    )
    model = quality.fit(measured.join(known, "doc_id"), "statistics", "label", fold(4) == 3)
    scored = quality.with_score(measured, "statistics", model)
    return scored.select(
        "doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    ready(pages)
    return pages.select("page_id", "url", webpages.extracted("html").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )


@query
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.scaled(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64.0)
    return topk.top_k(rows, rows.where(F.col("id") % 20 == 0))


@query
def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blocks.usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", zero=False)
    return ann.searched(rows, rows.where(F.col("id") % 100 == 0))


PII_KEY = "surrogates of the first release"


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.with_surrogates(documents, PII_KEY, count="n_replaced")


def domain(source: Column) -> Column:
    """The test tables have no domains: sources are dealt to four."""
    digit = F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(source), 1, 1)) - 1
    return F.concat(F.lit("domain"), (digit % 4).cast("string"))


def by_name(column: str, weights: dict[str, int], other: int) -> Column:
    out = F
    for name, weight in weights.items():
        out = out.when(F.col(column) == name, weight)
    return out.otherwise(other)


def mixing_levels() -> list[mixing.Level]:
    return [
        mixing.Level("__domain", domain(F.col("source")), by_name("__domain", {"domain0": 4, "domain1": 3, "domain2": 2}, 1)),
        mixing.Level("__lang", F.col("lang"), by_name("__lang", {"en": 5, "de": 2, "fr": 2}, 1)),
        mixing.Level("__source", F.col("source"), F.lit(1)),
    ]


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mixed(documents, mixing_levels()).select(
        "doc_id", F.col("__domain").alias("domain"), "lang", "source", "n_tokens", "copies"
    )


PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query
def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.with_ids(documents, PIECES).drop("text")
    return encoded.withColumn("n_tokens", F.coalesce(F.size("ids"), F.lit(0)))


@query
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


@query
def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.spans(table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


@query
def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scanned(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    starts = F.transform("base", lambda x: x["start"].cast("long"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        licenses.labels_of("base").alias("base_labels"),
        licenses.labels_of("base", "licenses").alias("labels"),
        licenses.sureness("licenses").alias("score"),
    )


@query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found, _ = centroids.clustered(rows, "vec_id", "embedding", width=64, factor=256.0, k=40, rounds=5, seed="2")
    return found.withColumnRenamed("id", "vec_id")


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    c = F.col("c")
    return tries.trie(
        turns, "conv_id", "turn", "role", "text",
        lender=c - c % 5, borrowed=F.crc32(c.cast("string")) % 9, most=8,
    )
