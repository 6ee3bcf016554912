"""Test relations derived from the given tables; each has an SQL twin in ``oracle``."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import Featurizer
from ..functions.labels import decode_label
from ..operators.linear import LinearScorer, one_row_per_model
from ..plans.extract import PARTITIONS, feature_rows
from ..plans.train import evaluate
from ..schemas import FEATURE_WIDTH, LOGISTIC_REGRESSION, RANDOM_FOREST
from ..session import drop_folder, make_folder, run_folder, ship_package
from ..sources.listing import opened
from ..sources.tables import write_table

WIDTH = 64
WEIGHTS = tuple(((i * 37) % 17 - 8) / 8.0 for i in range(WIDTH))
SCORERS = {LOGISTIC_REGRESSION: LinearScorer(WEIGHTS), RANDOM_FOREST: LinearScorer(WEIGHTS[::-1])}
TRAIN_SECONDS = {LOGISTIC_REGRESSION: 1.0, RANDOM_FOREST: 2.0}  # stand-ins: these models are not fitted
BYTE_WEIGHTS = tuple(((b * 37) % 17 - 8) / 4096.0 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_of(key: Column) -> Column:
    """Five training rows to one test row, as a label on every row."""
    return F.when(key % 6 == 0, "test").otherwise("train")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FEAT: embeddings in the shape of the features table."""
    label = (F.col("label") % 2).cast("int")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id"),
        F.col("vec_id").cast("string").alias("path"),
        F.col("embedding").alias("features"),
        F.when(F.col("embedding").isNull(), "no embedding").alias("error"),
        label.alias("label"),
        decode_label(label).alias("label_name"),
        split_of(F.col("vec_id")).alias("split"),
    )


def scored_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCORED: FEAT under two fixed linear models, one row per model and vector."""
    wide = features(spark, sf_dir).select(
        "vec_id",
        "path",
        "label",
        "label_name",
        *[s.probability(F.col("features")).alias(name) for name, s in SCORERS.items()],
    )
    return one_row_per_model(wide, {name: name for name in SCORERS})


def scored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LI: order lines under two rules with many equal scores; the volume case."""
    label = (F.col("l_returnflag") == "R").cast("int")
    wide = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("path"),
        label.alias("label"),
        decode_label(label).alias("label_name"),
        (F.col("l_quantity") / 50 * 0.9 + F.col("l_discount")).alias(LOGISTIC_REGRESSION),
        (F.col("l_quantity") / 50 * 0.6 + F.col("l_tax") * 5).alias(RANDOM_FOREST),
    )
    return one_row_per_model(wide, {LOGISTIC_REGRESSION: LOGISTIC_REGRESSION, RANDOM_FOREST: RANDOM_FOREST})


def classified_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DOCS: every document; label and answer are null where nobody judged it.

    The answer is a rule on length, quality and language, so errors of both kinds occur.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    judged = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    rule = F.when((F.col("quality") == 0) | (F.col("n_chars") % 5 == 0), 1.0).otherwise(0.0)
    label = F.col("toxic").cast("int")
    return judged.select(
        F.lit("LengthRule").alias("model"),
        "doc_id",
        F.col("doc_id").cast("string").alias("path"),
        label.alias("label"),
        decode_label(label).alias("label_name"),
        split_of(F.col("doc_id")).alias("split"),
        F.when(label.isNotNull(), rule).alias("prediction"),
    )


def file_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BYTES: raw pages in the place of image files, with a split and a label."""
    label = (F.col("page_id") % 2).cast("int")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.col("url").alias("path"),
        F.encode("html", "UTF-8").alias("content"),
        label.alias("label"),
        decode_label(label).alias("label_name"),
        split_of(F.col("page_id")).alias("split"),
    )


def broken_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BYTES where folder pages have empty content and paged ones none at all."""
    content = F.when(F.col("path").endswith("/"), F.lit("").cast("binary")).when(
        ~F.col("path").contains("page="), F.col("content")
    )
    return file_bytes(spark, sf_dir).withColumn("content", content)


def vector_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics table of SCORED."""
    return evaluate(scored_vectors(spark, sf_dir), TRAIN_SECONDS)


def judged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as answers with a time, whose labels come up to 40 minutes later, or never."""
    key = F.col("o_orderkey")
    answered = F.timestamp_seconds(key * 10)
    return table(spark, sf_dir, "orders").select(
        F.lit("PriceRule").alias("model"),
        key.cast("string").alias("path"),
        (F.col("o_custkey") % 10 < 5).cast("double").alias("prediction"),
        answered.alias("answered_at"),
        F.when(key % 9 != 0, (F.col("o_totalprice") > 150000).cast("int")).alias("label"),
        (answered + F.make_dt_interval(secs=(key % 5 * 600).cast("decimal(18,6)"))).alias("labelled_at"),
    )


# ---- files that tasks write from the tables, one per row ----------------------


def _line(value: Column) -> Column:
    """A line of text; null is an empty one."""
    return F.concat(F.coalesce(value.cast("binary"), F.lit(b"")), F.lit(b"\n"))


LANDED = "partition string, content binary"


def _one_file_per_row(rows: DataFrame, folder: str, by: tuple[str, ...] = (), ending: str = "txt") -> None:
    """Write the last column of each row as a file of its own below ``by`` folders; null is a file of zero bytes.

    Tasks open the files themselves: Spark's writers move each file twice and one by one at the end of a job, and
    set its rights by a process. A task that is tried again writes the same names. The rows are spread over all
    cores however few splits the table has.
    """
    spark = rows.sparkSession
    ship_package(spark)
    target = make_folder(spark, folder)
    names = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))) for c in by]
    spread = rows.repartition(spark.sparkContext.defaultParallelism)
    lines = spread.select(F.concat_ws("/", *names).alias("partition"), F.col(rows.columns[-1]).cast("binary").alias("content"))
    job = uuid.uuid4().hex

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inside, _ = opened(target)
        task, number, made = TaskContext.get().partitionId(), 0, set()
        for batch in batches:
            for place, content in zip(batch["partition"].to_pylist(), batch["content"].to_pylist(), strict=True):
                parent = f"{inside}/{place}".rstrip("/")
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(f"{parent}/part-{task:05d}-{job}-{number:06d}.{ending}") as file:
                    file.write(content or b"")
                number += 1
        yield from ()

    lines.mapInArrow(write, LANDED).write.format("noop").mode("overwrite").save()


def land_pages(spark: SparkSession, sf_dir: str) -> str:
    """Each page as a file in split and label folders; a line end closes each file."""
    folder = run_folder(spark, "page-files")
    pages = file_bytes(spark, sf_dir).select("split", "label_name", _line(F.col("content")))
    _one_file_per_row(pages, folder, ("split", "label_name"))
    return folder


def add_empty_files(spark: SparkSession, folder: str) -> str:
    """One file of zero bytes in each split and label folder, as a table without rows leaves it."""
    nothing = spark.createDataFrame([], "value string")
    for split in ("train", "test"):
        for label in ("REAL", "FAKE"):
            nothing.write.mode("append").text(f"{folder}/split={split}/label_name={label}")
    return folder


def replace_folder(spark: SparkSession, sf_dir: str, folder: str, mode: str) -> None:
    """The training pages of label FAKE, twice as long, in the place of those that were landed, or beside them."""
    pages = file_bytes(spark, sf_dir).where((F.col("split") == "train") & (F.col("label_name") == "FAKE"))
    text = F.col("content").cast("string")
    place = f"{folder}/split=train/label_name=FAKE"
    if mode == "overwrite":
        drop_folder(spark, place)
    _one_file_per_row(pages.select(_line(F.concat(text, text))), place)


def land_endings(spark: SparkSession, sf_dir: str) -> str:
    """Each page as a file of hex digits: jPg for training rows, png for test rows, and all again as txt."""
    folder = run_folder(spark, "ending-files")
    pages = file_bytes(spark, sf_dir).select("split", F.hex("content").alias("digits"))
    digits = F.col("digits")
    csv_line = _line(F.when(digits == "", '""').otherwise(digits))
    csv_line = F.when(digits.isNotNull(), csv_line)  # of a null alone CSV makes nothing at all
    for ending, split in (("jPg", "train"), ("png", "test")):
        part = pages.where(F.col("split") == split).select(csv_line)
        _one_file_per_row(part, f"{folder}/{ending}", ending=ending)
    _one_file_per_row(pages.select(_line(digits)), f"{folder}/txt")
    return folder


# Header of an uncompressed 24 bit bitmap of 8 by 8 pixels.
BITMAP_HEADER = struct.pack("<2sIHHI", b"BM", 54 + 192, 0, 0, 54) + struct.pack(
    "<IiiHHIIiiII", 40, 8, 8, 1, 24, 0, 192, 2835, 2835, 0, 0
)


def land_pictures(spark: SparkSession, sf_dir: str) -> str:
    """Each embedding as an 8 by 8 picture file: value v is level floor((v + 1) * 127.5).

    Blue holds the level, green its complement and red the level halved.
    """
    folder = run_folder(spark, "picture-files")

    def pixel(v: Column) -> Column:
        level = F.floor((v.cast("double") + 1) * 127.5)
        parts = [level, 255 - level, F.floor(level / 2)]
        return F.concat(*[F.lpad(F.hex(p), 2, "0") for p in parts])

    rows = features(spark, sf_dir).select(
        "split",
        "label_name",
        F.unhex(F.concat(F.lit(BITMAP_HEADER.hex()), F.array_join(F.transform("features", pixel), ""))).alias("content"),
    ).withColumn("content", _line(F.col("content")))
    _one_file_per_row(rows, folder, ("split", "label_name"))
    return folder


def _key_and_price(content: bytes) -> tuple[float, float]:
    key, price = content.split(b"|")
    return float(key), float(price)


def _noisy_prices(orders: list[tuple[float, float]]) -> np.ndarray:
    keys, prices = np.asarray(orders).T[:, :, None]
    dim = np.arange(FEATURE_WIDTH)
    noise = np.sin(keys * (dim + 1) * 12.9898) * 43758.5453 % 1
    signal = np.tanh((prices - 150000) / 100000) * (dim % 5 - 2)
    return (noise + signal / 25).astype(np.float32)


def _load_noisy_prices():
    return _key_and_price, _noisy_prices


def noisy_prices() -> Featurizer:
    """Noise per order and dimension with a trace of the price, as wide as the pretrained network."""
    return Featurizer("noisy_prices", FEATURE_WIDTH, _load_noisy_prices)


def land_wide_features(spark: SparkSession, sf_dir: str) -> str:
    """A features table of published width, one row per order; the label is a price above 150,000."""
    folder = run_folder(spark, "wide-features")
    label = (F.col("o_totalprice") > 150000).cast("int")
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("path"),
        F.concat_ws("|", "o_orderkey", "o_totalprice").cast("binary").alias("content"),
        label.alias("label"),
        decode_label(label).alias("label_name"),
        split_of(F.col("o_orderkey")).alias("split"),
    )
    spread = raw.repartition(2 * spark.sparkContext.defaultParallelism)
    write_table(feature_rows(spread, noisy_prices()), folder, partition_by=PARTITIONS)
    return folder
