import pytest

from pixelproof.operators import decisions
from pixelproof.schemas import METRICS


def metrics(spark, lr, rf):
    rows = [("LogisticRegression", lr, 0.5, 0.5, 0.5, 0.5, 1.0), ("RandomForest", rf, 0.5, 0.5, 0.5, 0.5, 2.0)]
    return spark.createDataFrame(rows, METRICS)


@pytest.mark.parametrize(
    "lr, rf, best",
    [(0.9, 0.8, "LogisticRegression"), (0.8, 0.9, "RandomForest"), (0.9, 0.9, "LogisticRegression")],
)
def test_champion(spark, lr, rf, best):
    assert decisions.champion(metrics(spark, lr, rf)).first()["best_model"] == best


def test_priority_decides_ties(spark):
    found = decisions.champion(metrics(spark, 0.9, 0.9), priority=("RandomForest", "LogisticRegression"))
    assert found.first()["best_model"] == "RandomForest"


def test_verdict_needs_more_than_the_threshold(spark):
    assert decisions.verdict(metrics(spark, 0.7, 0.6)).first()["sufficient"] is False
    assert decisions.verdict(metrics(spark, 0.71, 0.6)).first()["sufficient"] is True
    assert decisions.verdict(metrics(spark, 0.71, 0.6), threshold=0.8).first()["sufficient"] is False


def test_unknown_model_gives_no_row(spark):
    assert decisions.metric_lookup(metrics(spark, 0.1, 0.2), "Other").count() == 0


def test_insufficient_features(spark):
    images = spark.range(5)
    facts = {
        r["metric"]: r["value"]
        for r in decisions.insight_facts(metrics(spark, 0.6, 0.5), images, "d", "Net (x)", 1280).collect()
    }
    assert facts["Conclusion"] == "Features need improvement"
    assert facts["LR Accuracy"] == "60.00%" and facts["Total Images"] == "5"


def test_missing_tables_are_reported_not_invented(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    spark.range(0).write.parquet(str(tmp_path / "b"))
    sizes = decisions.table_sizes(spark, {n: str(tmp_path / n) for n in ("a", "b", "c")})
    assert {r["table_name"]: r["n_rows"] for r in sizes.collect()} == {"a": 3, "b": 0, "c": None}
    check = decisions.output_check(sizes, needed=2).first()
    assert (check["n_expected"], check["n_filled"], check["passed"]) == (3, 1, False)


def only(spark, *rows):
    return spark.createDataFrame([(name, acc, 0.5, 0.5, 0.5, 0.5, 1.0) for name, acc in rows], METRICS)


@pytest.mark.parametrize(
    "rows, name, title, accuracy",
    [
        ([("RandomForest", 0.9)], "RandomForest", "Random Forest", "90.00%"),
        ([("LogisticRegression", 0.7), ("RandomForest", 0.8), ("Net", 0.9)], "Net", "Net", "90.00%"),
        ([("Net", 0.9), ("RandomForest", 0.9)], "RandomForest", "Random Forest", "90.00%"),
        ([("LogisticRegression", None), ("RandomForest", 0.1)], "RandomForest", "Random Forest", "10.00%"),
    ],
)
def test_all_reports_name_the_same_winner(spark, rows, name, title, accuracy):
    table = only(spark, *rows)
    assert decisions.champion(table).first()["best_model"] == name
    facts = {r["metric"]: r["value"] for r in decisions.insight_facts(table, spark.range(1), "d", "Net", 2).collect()}
    assert (facts["Best Model"], facts["Best Accuracy"]) == (title, accuracy)
    report = {r["key"]: r["value"] for r in decisions.report_facts(table, "p").collect()}
    assert (report["best_model"], report["best_accuracy"]) == (name, accuracy)


def test_no_model_no_champion(spark):
    assert decisions.champion(only(spark).limit(0)).count() == 0


def test_comparison_does_not_leave_a_model_out(spark):
    with pytest.raises(Exception, match="no column for model Net"):
        decisions.model_comparison(only(spark, ("Net", 0.9))).collect()
