"""From documents to token ids: filter, join near copies, hide personal data, mix, encode.

Each stage takes what its predecessor kept, written and read again, so a lost executor costs no more than
the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelproof.llm import mixing, ngram_join, pieces, pii, toxicity
from pixelproof.llm.queries import PIECES, PII_KEY, fold, mixing_levels, table
from pixelproof.llm.work import store

ORACLE_SQL = None  # the first stage fits a model; the tests compare the others with brute force


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled ones among them."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(fold(3) != 1))
    score = toxicity.scorer(docs, model)
    return docs.where(toxicity.predicted(score("text")) == 0)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id, once; documents without words all stay.

    Of several rows of that id the one with the smallest text stays, then by the other columns.
    """
    groups = store(ngram_join.joined(docs), "groups").rows
    later = ngram_join.checked(spark, store(groups.where("id <> component").select(F.col("id").alias("__id")).distinct(), "later"))
    counts = groups.where("id = component").groupBy("id").agg(F.count("*").alias("n"))
    again = ngram_join.checked(spark, store(counts.where("n > 1").select(F.col("id").alias("__id")), "again"))
    same = F.col("doc_id") == F.col("__id")
    kept = docs.join(later, same, "left_anti")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    least = kept.join(again, same, "left_semi").groupBy("doc_id").agg(F.min(F.struct("text", *others)).alias("__row"))
    one = least.select("doc_id", *[F.col("__row")[c].alias(c) for c in ("text", *others)])
    return kept.join(again, same, "left_anti").unionByName(one)


def hide_persons(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data."""
    return pii.with_surrogates(docs, PII_KEY).withColumn("n_chars", F.length("text").cast("bigint"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget asks for them."""
    mixed = mixing.mixed(docs, mixing_levels(), copies="__copies", count="__tokens")
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids."""
    encoded = pieces.with_ids(docs, PIECES)
    return encoded.withColumn("n_tokens", F.coalesce(F.size("ids"), F.lit(0)))


STAGES = [
    ("toxicity", keep_civil),
    ("n-gram Jaccard join", keep_one_of_each),
    ("PII", hide_persons),
    ("mixing", mix),
    ("SentencePiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        made = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if read:
            read.discard()
        docs, read = made.rows, made
    return docs
