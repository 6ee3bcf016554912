import numpy as np
import pytest
from fixtures import predictions
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from pixelproof.operators import ranking
from pixelproof.operators.confusion import CELLS, cell_counts, confusion_cells


SCORES = [0.0, 0.2, 0.2000001, 0.5, 0.9, 1.0, 3.5, -2.0]


def brute_force_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    if not pos or not neg:
        return None
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def scored(spark, pairs, model="m"):
    return predictions(spark, [(model, str(i), y, float(s > 0.5), float(s)) for i, (y, s) in enumerate(pairs)])


def auc(df, **options):
    return ranking.auc_exact(df, **options).first()["auc_roc"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    pairs=st.lists(st.tuples(st.integers(0, 1), st.sampled_from(SCORES)), min_size=2, max_size=40),
    buckets=st.integers(2, 9),
)
def test_equals_all_pairs(spark, pairs, buckets):
    expected = brute_force_auc(pairs)
    found = auc(scored(spark, pairs), buckets=buckets)
    assert found is None if expected is None else found == pytest.approx(expected, abs=1e-12)


@pytest.fixture(scope="module")
def hot_pairs():
    """A third of the rows share one score."""
    random = np.random.default_rng(7)
    pairs = [(int(y), float(s)) for y, s in zip(random.integers(0, 2, 400), random.random(400), strict=True)]
    return pairs + [(int(y), 0.25) for y in random.integers(0, 2, 200)]


def test_hot_score_and_any_cuts(spark, hot_pairs):
    expected = brute_force_auc(hot_pairs)
    df = scored(spark, hot_pairs)
    for buckets in (2, 7, 300):
        assert auc(df, buckets=buckets) == pytest.approx(expected, abs=1e-12)


def test_symmetry_and_monotone_maps(spark, hot_pairs):
    df = scored(spark, hot_pairs)
    area = auc(df)
    assert auc(df.withColumn("fake_probability", 1 - F.col("fake_probability"))) == pytest.approx(1 - area)
    assert auc(df.withColumn("fake_probability", F.exp("fake_probability") * 3)) == pytest.approx(area)


def test_agrees_with_the_binning_evaluator(spark, hot_pairs):
    df = scored(spark, hot_pairs)
    p = F.col("fake_probability")
    raw = df.withColumn("rawPrediction", array_to_vector(F.array(1 - p, p)))
    assert BinaryClassificationEvaluator(labelCol="label", numBins=0).evaluate(raw) == pytest.approx(auc(df))


def test_models_apart_and_unusable_rows_left_out(spark):
    good = [(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.6)]
    rows = [("a", str(i), y, 1.0, s) for i, (y, s) in enumerate(good)]
    rows += [("b", str(i), y, 1.0, 1 - s) for i, (y, s) in enumerate(good)]
    rows += [("a", "n1", None, 1.0, 0.5), ("a", "n2", 1, None, None), ("a", "n3", 0, 1.0, float("nan"))]
    rows += [("c", "o", 1, 1.0, 0.7)]
    df = predictions(spark, rows)
    found = {r["model"]: r for r in ranking.auc_exact(df, counts=cell_counts()).collect()}
    assert found["a"]["auc_roc"] == 0.75 and found["b"]["auc_roc"] == 0.25
    assert found["c"]["auc_roc"] is None
    assert (found["a"]["n_pos"], found["a"]["n_neg"]) == (2, 2)
    apart = {r["model"]: r for r in confusion_cells(df).collect()}
    for model, row in apart.items():
        for cell in (*CELLS, "n_null", "n_rows"):
            assert found[model][cell] == row[cell]


def test_no_predictions(spark):
    assert ranking.auc_exact(predictions(spark, [])).count() == 0


def test_threshold_sweep_equals_one_pass_per_threshold(spark, hot_pairs):
    thresholds = [0.0, 0.25, 0.4, 0.5, 0.99, 1.0]
    found = ranking.threshold_sweep(scored(spark, hot_pairs), thresholds).collect()
    assert len(found) == len(thresholds)
    for row in found:
        t = row["threshold"]
        assert row["true_positive"] == sum(y == 1 and s > t for y, s in hot_pairs)
        assert row["false_positive"] == sum(y == 0 and s > t for y, s in hot_pairs)
        assert row["true_negative"] == sum(y == 0 and s <= t for y, s in hot_pairs)
        assert row["false_negative"] == sum(y == 1 and s <= t for y, s in hot_pairs)


def test_sample_per_class_with_and_without_group_limit(spark):
    rows = spark.range(5000).select(
        F.lpad(F.col("id").cast("string"), 5, "0").alias("path"),
        F.when(F.col("id") % 3 == 0, "REAL").otherwise("FAKE").alias("label_name"),
    )
    for n in (10, 1500):
        found = ranking.sample_per_class(rows, n).collect()
        for name, keep in (("REAL", 0), ("FAKE", 1)):
            expected = [f"{i:05d}" for i in range(5000) if (i % 3 == 0) == (keep == 0)][:n]
            assert sorted(r["path"] for r in found if r["label_name"] == name) == expected


def test_ties_at_the_top_are_broken_by_path(spark):
    rows = spark.createDataFrame([("b", 9.0), ("a", 9.0), ("c", 10.0)], "path string, confidence double")
    assert [r["path"] for r in ranking.top_suspects(rows, 2).collect()] == ["c", "a"]


@pytest.mark.parametrize("n", [900, 1500])
def test_sample_of_any_classes_at_any_size(spark, n):
    """Four classes, one of them null, and one with most of the rows; also by two columns."""
    rows = spark.range(8000).select(
        F.lpad(F.col("id").cast("string"), 5, "0").alias("path"),
        F.expr("CASE WHEN id % 8 = 0 THEN 'REAL' WHEN id % 8 = 1 THEN 'OTHER' WHEN id % 8 > 2 THEN 'FAKE' END").alias("c"),
        (F.col("id") % 2).alias("model"),
    )
    found = ranking.sample_per_class(rows, n, "c").collect()
    place = Window.partitionBy("c").orderBy("path")
    expected = rows.withColumn("p", F.row_number().over(place)).where(f"p <= {n}").drop("p").collect()
    assert sorted(map(str, found)) == sorted(map(str, expected)) and {r["c"] for r in found} == {"REAL", "OTHER", "FAKE", None}
    two = ranking.sample_per_class(rows, 100, ("model", "c")).groupBy("model", "c").count().collect()
    assert len(two) == 5 and {r["count"] for r in two} == {100}


@pytest.mark.parametrize("n, splits, few", [(1, 3, 7), (700, 3, 7), (2999, 48, 100), (10_000, 3, 7)])
def test_sample_is_selected_by_counting(spark, monkeypatch, n, splits, few):
    """Skewed classes, null and repeated keys, long common prefixes; only ``few`` rows of a class are put in order."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("file:/the/same/long/folder/"), F.lpad((F.col("id") * 7919 % 4001).cast("string"), 6, "0"))).alias("path"),
        F.expr("CASE WHEN id % 40 = 0 THEN 'A' WHEN id % 40 > 1 THEN 'B' END").alias("c"),
        "id",
    )
    found = ranking.sample_per_class(rows, n, "c", splits=splits, few=few)
    order = Window.partitionBy("c").orderBy(F.col("path").asc_nulls_first(), F.xxhash64("path", "c", "id"))
    expected = rows.withColumn("p", F.row_number().over(order)).where(F.col("p") <= n).drop("p")
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1

    cuts = ranking._cuts(
        rows.select(F.struct("c").alias("_class"), F.struct(F.col("path").isNotNull().alias("known"), F.col("path").alias("key"), F.xxhash64("path", "c", "id").alias("tie")).alias("_at")),
        n, splits, few,
    )
    assert all(r["rest"] is None or r["rest"] <= few for r in cuts.collect())


def test_sample_of_equal_and_of_no_rows(spark):
    rows = spark.createDataFrame([("a", "x")] * 500 + [("b", "x")] * 3, "path string, c string")
    assert ranking.sample_per_class(rows, 40, "c", splits=4, few=10).count() == 40
    assert ranking.sample_per_class(rows.limit(0), 40, "c").count() == 0


def test_ranges_do_not_change_the_area(spark, hot_pairs):
    areas = {round(ranking.auc_exact(scored(spark, hot_pairs), buckets=b).first()["auc_roc"], 12) for b in (1, 3, 50)}
    areas.add(round(ranking.auc_exact(scored(spark, hot_pairs)).first()["auc_roc"], 12))
    assert len(areas) == 1


def test_predictions_are_read_once(spark, hot_pairs):
    """Each prediction passes a counting task once, whatever jobs the area takes."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rows = scored(spark, hot_pairs)
    ranking.auc_exact(rows.mapInPandas(counted, rows.schema)).collect()
    assert read.value == len(hot_pairs)


def test_thresholds_send_no_model_to_one_task(spark):
    """Spark does not know that the table of thresholds is small, and would shuffle all rows by model to join it."""
    rows = scored(spark, [(i % 2, i / 50) for i in range(50)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        plan = ranking.thresholds_for_rates(rows, (0.1,))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_sampled_rows_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(n):
        made.add(1)
        return n

    rows = spark.range(400).select(counted("id").alias("path"), (F.col("id") % 2).alias("label_name"))
    found = ranking.sample_per_class(rows, 100, few=20, splits=4)
    assert sorted(r["path"] for r in found.collect()) == list(range(200))
    assert made.value == 400
