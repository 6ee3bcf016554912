"""One-pass totals, observed counts, thresholds for rates and sketched areas against plainer ways."""

import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pixelproof.operators import confusion, distribution, ranking, totals
from pixelproof.sources import counted, files
from pixelproof.sources.tables import write_table

ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).select(
        F.expr("CASE WHEN id % 17 != 0 THEN 'm' || (id % 2) END").alias("model"),
        F.expr("CASE id % 5 WHEN 0 THEN 'test' WHEN 1 THEN NULL ELSE 'train' END").alias("split"),
        F.expr("CASE id % 3 WHEN 0 THEN 'REAL' WHEN 1 THEN 'FAKE' END").alias("label_name"),
        F.expr("CASE id % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 END").alias("label"),
        (F.col("id") % 2).cast("double").alias("prediction"),
        (F.col("id") % 7).alias("length"),
    )


def same(one, other):
    assert sorted(one.columns) == sorted(other.columns)
    assert sorted(map(str, one.select(sorted(one.columns)).collect())) == sorted(map(str, other.select(sorted(one.columns)).collect()))


def test_tables_projected_from_one_pass(rows):
    found = totals.all_totals(rows)
    same(totals.class_distribution(found), distribution.class_distribution(rows))
    same(totals.dataset_sizes(found), distribution.dataset_sizes(rows))
    same(totals.file_inventory(found), files.file_inventory(rows))
    errors = confusion.error_by_class(rows.withColumn("label", F.col("label")))
    same(totals.error_by_class(found), errors)
    same(totals.dataset_sizes(totals.all_totals(rows.limit(0))), distribution.dataset_sizes(rows.limit(0)))


def test_totals_read_their_rows_once(spark, rows, tmp_path):
    write_table(rows, str(tmp_path / "rows"))
    found = totals.all_totals(spark.read.parquet(str(tmp_path / "rows")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1


def test_counts_of_writes(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    wanted = {"n_fake": F.count_if(F.col("label") == 1)}
    assert counted.write_counted(rows, path, wanted) == {"n_rows": 3000, "n_fake": 1000}
    counted.write_counted(rows.where("label = 1"), path, wanted, mode="append")
    counted.write_counted(rows.limit(0), path, wanted, mode="append")
    assert tuple(counted.counted(spark, path).first()) == (4000, 2000)
    assert tuple(counted.counts_agree(spark, path).first()) == (4000, 4000, True)
    write_table(rows, path, mode="append")  # not counted
    assert not counted.counts_agree(spark, path).first()["agree"]


RETRIED = """
import os, sys
sys.path.insert(0, {root!r})
from pixelproof.session import build_session
from pixelproof.sources import counted
spark = build_session(master="local[2,4]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "3"}})
def fragile(batches):
    from pyspark import TaskContext
    for batch in batches:
        yield batch
    if TaskContext.get().partitionId() == 1 and TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost after its rows were seen")
rows = spark.range(0, 1000, 1, 4).mapInPandas(fragile, "id long")
print("SEEN", counted.write_counted(rows, {out!r})["n_rows"], counted.counts_agree(spark, {out!r}).first()["agree"])
"""


def test_a_retried_task_counts_once(tmp_path):
    code = RETRIED.format(root=str(ROOT), out=str(tmp_path / "t"))
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=150)
    assert "SEEN 1000 True" in run.stdout, run.stderr[-2000:]


# ---- thresholds and sketched areas --------------------------------------------------
def scored(spark, pairs):
    return spark.createDataFrame([("m", str(i), y, s) for i, (y, s) in enumerate(pairs)], "model string, path string, label int, fake_probability double")


PAIRS = {
    "ties": [(i % 2, float(i * 37 % 11)) for i in range(400)],
    "one score": [(i % 3 % 2, 0.25) for i in range(30)],
    "spread": [(i % 2, (i * 7919 % 1009) / 1009 + (i % 2) * 0.1) for i in range(1009)],
    "far apart": [(0, 1e-300), (0, 1.0), (0, 1.0 + 2**-52), (1, 0.5), (0, 1e300), (1, 2.0), (0, -5.0)],
    "odd": [(0, 0.5), (None, 0.9), (1, None), (7, 0.1), (0, float("nan")), (1, 0.7)],
}


@pytest.mark.parametrize("case", PAIRS)
@pytest.mark.parametrize("bins", [2, 1000])
def test_threshold_is_the_smallest_that_keeps_the_rate(spark, case, bins):
    if bins == 2 and case != "spread":
        pytest.skip("one case is enough for many passes")
    rates = [0.0, 0.01, 0.05, 0.5, 1.0]
    found = {r["target_rate"]: r for r in ranking.thresholds_for_rates(scored(spark, PAIRS[case]), rates, bins=bins).collect()}
    usable = [(y, s) for y, s in PAIRS[case] if y in (0, 1) and s is not None and s == s]
    real = [s for y, s in usable if y == 0]
    for rate in rates:
        allowed = int(Decimal(str(rate)) * len(real))
        best = min(t for t in real if sum(s > t for s in real) <= allowed)
        r = found[rate]
        assert (r["threshold"], r["false_positive"]) == (best, sum(s > best for s in real))
        assert r["true_positive"] == sum(s > best for y, s in usable if y == 1)


def test_no_threshold_without_real_rows(spark):
    assert ranking.thresholds_for_rates(scored(spark, [(1, 0.5)]), [0.1]).count() == 0


@pytest.mark.parametrize("points, accuracy", [(500, 20_000), (20, 200)])
def test_sketched_area_lies_within_its_bound(spark, points, accuracy):
    for pairs in PAIRS.values():
        rows = scored(spark, pairs)
        exact = ranking.auc_exact(rows).first()["auc_roc"]
        r = ranking.auc_sketched(rows, points=points, accuracy=accuracy).first()
        assert abs(r["auc_sketched"] - exact) <= r["error_bound"] + 1e-12
    assert ranking.auc_sketched(scored(spark, [(1, 0.5)])).first()["auc_sketched"] is None
    plan = ranking.auc_sketched(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile_approx" in plan
