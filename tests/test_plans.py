import numpy as np
import pytest
from fixtures import png_tree, separable
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from pixelproof.functions.featurizers import byte_histogram, pixel_histogram
from pixelproof.functions.features import Featurizer
from pixelproof.functions.labels import decode_label
from pixelproof.operators.distribution import class_distribution, dataset_sizes
from pixelproof.operators.linear import LinearScorer
from pixelproof.plans import extract, train
from pixelproof.plans.extract import pending, quarantined, run_extraction
from pixelproof.plans.run import run_all, run_sample
from pixelproof.plans.score import refitted, run_scoring, score_features, score_new
from pixelproof.schemas import FEATURES, METRICS, PREDICTIONS
from pixelproof.sources.counted import write_counted
from pixelproof.sources.files import scan_files
from pixelproof.sources.tables import read_table, write_table


@pytest.fixture(scope="module")
def rows(spark):
    return separable(spark).select(
        F.col("id").cast("string").alias("path"),
        array_to_vector("a").alias("features"),
        "label",
        decode_label(F.col("label")).alias("label_name"),
        F.when(F.col("id") % 6 == 0, "test").otherwise("train").alias("split"),
    )


@pytest.fixture(scope="module")
def fitted(rows):
    return train.fit_models(rows.where("split = 'train'"))


def test_kept_rows_give_the_same_models_and_are_released(spark, rows, fitted):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    again = train.fit_models(rows.where("split = 'train'"), keep=StorageLevel.MEMORY_AND_DISK)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    lr = again["LogisticRegression"].model.stages[-1].coefficients.toArray()
    assert lr == pytest.approx(fitted["LogisticRegression"].model.stages[-1].coefficients.toArray(), abs=1e-6)


@pytest.fixture(scope="module")
def scored(rows, fitted):
    return train.score_models(rows, {n: f.model for n, f in fitted.items()})


def test_separable_classes_are_learned(scored):
    metrics = {r["model"]: r for r in train.evaluate(scored).collect()}
    assert set(metrics) == {"LogisticRegression", "RandomForest"}
    assert all(m["accuracy"] > 0.95 and m["auc_roc"] > 0.99 for m in metrics.values())


def test_fitted_models_score_after_an_observed_write(spark, rows, tmp_path):
    write_counted(spark.range(3), str(tmp_path / "counted"))
    models = train.fit_models(rows.where("split = 'train'"))
    assert train.score_models(rows, {n: f.model for n, f in models.items()}).count() == 2 * rows.count()
    assert not any(f.model.stages[-1].hasSummary for f in models.values())


def test_chained_scoring_equals_each_model_alone(rows, fitted, scored):
    for name, one in fitted.items():
        alone = {r["path"]: r["prediction"] for r in one.model.transform(rows).select("path", "prediction").collect()}
        ours = {r["path"]: r["prediction"] for r in scored.where(F.col("model") == name).collect()}
        assert ours == alone


def test_logistic_regression_by_hand(rows, fitted):
    """Answers from the coefficients and the training deviations, outside Spark."""
    scaling, model = fitted["LogisticRegression"].model.stages
    data = rows.collect()
    train_x = np.array([r["features"].toArray() for r in data if r["split"] == "train"])
    assert scaling.std.toArray() == pytest.approx(train_x.std(axis=0, ddof=1))
    x = np.array([r["features"].toArray() for r in data]) / train_x.std(axis=0, ddof=1)
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    found = train.score_models(rows, {"m": fitted["LogisticRegression"].model})
    by_path = {r["path"]: r["fake_probability"] for r in found.collect()}
    assert [by_path[r["path"]] for r in data] == pytest.approx(list(p))


def test_forest_importance_sums_to_one_and_finds_the_signal(spark, fitted):
    found = train.feature_importance(fitted["RandomForest"].model, spark).orderBy(F.desc("importance")).collect()
    assert sum(r["importance"] for r in found) == pytest.approx(1.0)
    assert {r["dim"] for r in found[:2]} == {0, 1}


def test_stored_models_answer_the_same(rows, fitted, scored, tmp_path):
    reloaded = {}
    for name, one in fitted.items():
        train.save_model(one.model, str(tmp_path / name))
        reloaded[name] = train.load_model(str(tmp_path / name))
    again = train.score_models(rows, reloaded)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, scored.collect()))


def test_model_knows_its_featurizer(fitted, tmp_path):
    model, path = fitted["LogisticRegression"].model, str(tmp_path / "model")
    mine = Featurizer("mine", 16, lambda: None)
    train.save_model(model, path, mine)
    assert train.load_model(path, mine).stages[-1].numFeatures == 16
    for other in (Featurizer("other", 16, lambda: None), Featurizer("mine", 17, lambda: None)):
        with pytest.raises(train.FeaturizerMismatch):
            train.load_model(path, other)


def test_lower_threshold_calls_more_files_fake(rows, fitted):
    model = fitted["LogisticRegression"].model
    arrays = rows.select(
        "path", vector_to_array("features").cast("array<float>").alias("features"), F.lit(None).alias("error")
    )
    for t in (0.05, 0.4, 0.9):
        found = score_features(arrays, model, 16, threshold=t).collect()
        assert all((r["prediction"] == 1.0) == (r["confidence"] > 100 * t) for r in found)
        assert all((r["result"] == "FAKE") == (r["prediction"] == 1.0) for r in found)
        stored = train.score_models(rows, {"m": model}, t).collect()
        assert all((r["prediction"] == 1.0) == (r["fake_probability"] > t) for r in stored)


def test_linear_scorer_refuses_another_width(spark):
    rows = spark.createDataFrame([("a", [1.0, 2.0]), ("b", None)], "path string, features array<float>")
    found = {r["path"]: r["prediction"] for r in LinearScorer((1.0, 1.0)).transform(rows).collect()}
    assert found == {"a": 1.0, "b": None}
    with pytest.raises(Exception, match="expected 3 features, got 2"):
        LinearScorer((1.0, 1.0, 1.0)).transform(rows).collect()


def test_subset_scores_equal_unless_the_scaler_is_refitted(spark, rows, fitted):
    model = fitted["LogisticRegression"].model
    stored = rows.select("path", F.col("features").alias("v"), F.lit(None).cast("string").alias("error"))
    arrays = stored.select("path", vector_to_array("v").cast("array<float>").alias("features"), "error")

    def answers(df, m):
        return {r["path"]: r["confidence"] for r in score_features(df, m, 16).collect()}

    whole = answers(arrays, model)
    part = arrays.where(F.col("path").cast("int") < 100)
    assert answers(part, model) == {k: whole[k] for k in answers(part, model)}
    refit = answers(part, refitted(model, part))
    assert any(abs(refit[k] - whole[k]) > 1e-6 for k in refit)


def test_wrong_vector_width_fails(spark, fitted):
    narrow = spark.createDataFrame([("a", [1.0, 2.0], None)], "path string, features array<float>, error string")
    with pytest.raises(Exception, match="(?i)size|dimension|length|index"):
        score_features(narrow, fitted["LogisticRegression"].model, 2).collect()


def test_ml_model_carries_broken_rows_through(spark, rows, fitted):
    data = [("ok", [0.0] * 16, None), ("bad", None, "ValueError: no content")]
    df = spark.createDataFrame(data, "path string, features array<float>, error string")
    for one in fitted.values():
        found = {r["path"]: r for r in score_features(df, one.model, 16).collect()}
        assert found["ok"]["result"] in ("REAL", "FAKE")
        assert (found["bad"]["prediction"], found["bad"]["result"], found["bad"]["confidence"]) == (None, None, None)


def files_of(tmp_path, **contents):
    for name, content in contents.items():
        (tmp_path / f"{name}.jpg").write_bytes(content)
    return str(tmp_path)


def test_scoring_stores_answers_csv_and_quarantine(spark, tmp_path):
    (tmp_path / "in").mkdir()
    root = files_of(tmp_path / "in", a=b"aaaa", b=b"broken", c=b"zz")

    def load():
        def decode(content):
            if content == b"broken":
                raise ValueError("cannot decode")
            return content

        return decode, lambda items: np.array([[i.count(b"a"), i.count(b"z")] for i in items])

    out = str(tmp_path / "out")
    scorer = LinearScorer((1.0, -1.0))
    run_scoring(scan_files(spark, root), Featurizer("letters", 2, load), scorer, out)
    found = {r["path"].rsplit("/", 1)[1]: r["result"] for r in read_table(spark, f"{out}/new_predictions").collect()}
    assert found == {"a.jpg": "FAKE", "b.jpg": None, "c.jpg": "REAL"}
    assert read_table(spark, f"{out}/new_quarantine").count() == 1
    assert spark.read.option("header", True).csv(f"{out}/new_predictions_csv").count() == 3


def test_refit_while_scoring_new_files(spark, tmp_path):
    root = files_of(tmp_path, a=b"aaaa", b=b"ab", c=b"zz")
    weights = tuple(1.0 if b == ord("a") else 0.0 for b in range(256))
    found = score_new(scan_files(spark, root), byte_histogram(), LinearScorer(weights), refit_scaler=True).collect()
    std = np.std([4, 1, 0], ddof=1)
    expected = {"a.jpg": 4, "b.jpg": 1, "c.jpg": 0}
    for row in found:
        p = 1 / (1 + np.exp(-expected[row["path"].rsplit("/", 1)[1]] / std))
        assert row["confidence"] == pytest.approx(100 * p)


@pytest.mark.parametrize("files_per_batch", [100_000, 5])
def test_extraction_resumes_and_quarantines(spark, tmp_path, files_per_batch):
    """In one batch and in several; broken and empty files are stored with their error, once."""
    png_tree(tmp_path)
    root, out = str(tmp_path / "raw"), str(tmp_path / "features")
    (tmp_path / "raw/train/REAL/bad.png").write_bytes(b"no picture")
    (tmp_path / "raw/train/FAKE/empty.PnG").write_bytes(b"")

    def extract_all():
        return run_extraction(spark, root, out, pixel_histogram(), decoded=True, files_per_batch=files_per_batch)

    first = extract_all()
    assert first.count() == 14
    assert sorted((r["label_name"], r["error"]) for r in quarantined(first).collect())[0] == ("FAKE", "ValueError: no content")
    assert quarantined(first).count() == 2
    assert extract_all().count() == 14
    (tmp_path / "raw/test/FAKE/new.png").write_bytes((tmp_path / "raw/test/FAKE/0000.png").read_bytes())
    assert extract_all().count() == 15


def test_extraction_stopped_between_batches_goes_on(spark, tmp_path, monkeypatch):
    png_tree(tmp_path)
    root, out = str(tmp_path / "raw"), str(tmp_path / "features")
    write, calls = extract.write_table, []

    def stopping(rows, path, **options):
        calls.append(path)
        if calls.count(out) == 2:
            raise KeyboardInterrupt
        write(rows, path, **options)

    monkeypatch.setattr(extract, "write_table", stopping)
    with pytest.raises(KeyboardInterrupt):
        run_extraction(spark, root, out, byte_histogram(), files_per_batch=4)
    kept = read_table(spark, out, FEATURES).count()
    assert 0 < kept < 12
    monkeypatch.undo()
    done = run_extraction(spark, root, out, byte_histogram(), files_per_batch=4)
    assert done.count() == 12 and done.select("path").distinct().count() == 12


def test_resuming_compares_listings_only(spark, tmp_path):
    """Even with a large table of finished files, no exchange or sort carries contents."""
    png_tree(tmp_path)
    out = str(tmp_path / "features")
    run_extraction(spark, str(tmp_path / "raw"), out, byte_histogram())
    (tmp_path / "raw/test/FAKE/new.png").write_bytes(b"x")
    broadcasts = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        todo = pending(extract.in_layout(extract.all_files(spark, str(tmp_path / "raw"))), read_table(spark, out, FEATURES))
        plan = todo._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in plan and "content#" not in plan
        assert todo.count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcasts)


def test_pending_keeps_only_what_is_missing(spark):
    raw = spark.createDataFrame([("a", 1), ("b", 2)], "path string, v int")
    assert [r["path"] for r in pending(raw, raw.where("v = 1")).collect()] == ["b"]
    assert pending(raw, raw).count() == 0


def test_whole_run_from_pictures_to_report(spark, tmp_path):
    png_tree(tmp_path, per_folder=12, size=8)
    root, out = str(tmp_path / "raw"), str(tmp_path / "run")
    check = run_all(spark, root, out, pixel_histogram(), "test pictures", decoded=True, generated="now").first()
    assert (check["n_expected"], check["n_filled"], check["passed"]) == (7, 7, True)
    metrics = read_table(spark, f"{out}/results/metrics")
    assert set(metrics.columns) == set(METRICS.fieldNames())
    assert metrics.where("accuracy > 0.95").count() == 2
    predictions = read_table(spark, f"{out}/results/predictions", PREDICTIONS)
    assert predictions.count() == 2 * 24
    facts = {r["metric"]: r["value"] for r in read_table(spark, f"{out}/results/business_insight").collect()}
    assert len(facts) == 14
    assert facts["Total Images"] == "48" and facts["Feature Dimension"] == "780"
    assert facts["Conclusion"] == "pixel_histogram features are SUFFICIENT for Deepfake detection"
    keys = {r["key"] for r in read_table(spark, f"{out}/results/report_info").collect()}
    assert keys == {"report_path", "best_model", "best_accuracy", "report_generated"}


def test_sample_of_stored_champion(spark, tmp_path):
    png_tree(tmp_path, per_folder=6, size=8)
    root, results = str(tmp_path / "raw"), str(tmp_path / "results")
    run_extraction(spark, root, str(tmp_path / "features"), byte_histogram())
    train.run_training(spark, str(tmp_path / "features"), results)
    found = run_sample(spark, root, results, byte_histogram(), n=4).collect()
    assert len(found) == 8
    assert sorted(r["actual_label"] for r in found) == ["FAKE"] * 4 + ["REAL"] * 4
    assert all("/test/" in r["path"] and r["predicted_label"] in ("REAL", "FAKE") for r in found)


def test_metric_jobs_do_not_read_vectors(spark, tmp_path):
    out = str(tmp_path / "features")
    data = [("a", [1.0], None, 0, "REAL", "train"), ("b", [2.0], None, 1, "FAKE", "test")]
    write_table(spark.createDataFrame(data, FEATURES), out, partition_by=("split", "label_name"))
    table = read_table(spark, out, FEATURES)
    for job in (class_distribution(table), dataset_sizes(table)):
        plan = job._jdf.queryExecution().executedPlan().toString()
        assert "features" not in plan.split("ReadSchema")[1]
    train_only = read_table(spark, out, FEATURES).where("split = 'train'")
    assert "PartitionFilters: [isnotnull(split" in train_only._jdf.queryExecution().executedPlan().toString()
