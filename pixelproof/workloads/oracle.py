"""SQL that gives the answers of ``queries`` on the same tables."""

from __future__ import annotations

# ---- relations -------------------------------------------------------------------

W = "[((i * 37) % 17 - 8) / 8.0 for i in range(0, 64)]::double[]"

FEAT = """
feat AS (
  SELECT vec_id, embedding, (label % 2)::int AS label,
         CASE label % 2 WHEN 0 THEN 'REAL' WHEN 1 THEN 'FAKE' END AS label_name,
         CASE WHEN vec_id % 6 = 0 THEN 'test' ELSE 'train' END AS split
  FROM embeddings)"""

SCORED = (
    FEAT
    + f""",
margins AS (
  SELECT 'LogisticRegression' AS model, vec_id, label, label_name,
         list_dot_product(embedding::double[], {W}) AS margin FROM feat
  UNION ALL
  SELECT 'RandomForest', vec_id, label, label_name,
         list_dot_product(embedding::double[], list_reverse({W})) FROM feat),
scored_p AS (
  SELECT model, vec_id, label, label_name, 1 / (1 + exp(-margin)) AS p FROM margins),
scored AS (
  SELECT *, (p > 0.5)::int::double AS prediction FROM scored_p)"""
)

LI = """
li_label AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS path,
         (l_returnflag = 'R')::int AS label, l_quantity, l_discount, l_tax
  FROM lineitem),
li_p AS (
  SELECT 'LogisticRegression' AS model, path, label, l_quantity / 50 * 0.9::double + l_discount AS p FROM li_label
  UNION ALL
  SELECT 'RandomForest', path, label, l_quantity / 50 * 0.6::double + l_tax * 5 FROM li_label),
scored AS (
  SELECT model, path, label, CASE label WHEN 0 THEN 'REAL' WHEN 1 THEN 'FAKE' END AS label_name, p,
         (p > 0.5)::int::double AS prediction
  FROM li_p)"""

DOCS = """
docs AS (
  SELECT 'LengthRule' AS model, doc_id, toxic::int AS label,
         CASE toxic WHEN 0 THEN 'REAL' WHEN 1 THEN 'FAKE' END AS label_name,
         CASE WHEN doc_id % 6 = 0 THEN 'test' ELSE 'train' END AS split,
         CASE WHEN toxic IS NULL THEN NULL
              WHEN quality = 0 OR n_chars % 5 = 0 THEN 1::double ELSE 0::double END AS prediction
  FROM documents LEFT JOIN labels USING (doc_id))"""

BYTES = """
files AS (
  SELECT page_id, url AS path, html, encode(html) AS content, (page_id % 2)::int AS label,
         CASE page_id % 2 WHEN 0 THEN 'REAL' WHEN 1 THEN 'FAKE' END AS label_name,
         CASE WHEN page_id % 6 = 0 THEN 'test' ELSE 'train' END AS split
  FROM pages)"""

BYTE_COUNTS = (
    BYTES
    + """,
digits AS (
  SELECT page_id, unnest(regexp_extract_all(hex(content), '..')) AS pair FROM files),
pairs AS (
  SELECT page_id, pair, count(*) AS n FROM digits GROUP BY page_id, pair),
byte_counts AS (
  SELECT page_id, ('0x' || pair)::int AS byte, n FROM pairs),
byte_scores AS (
  SELECT f.page_id, f.path, 1 / (1 + exp(-sum(n * (((byte * 37) % 17 - 8) / 4096.0::double)))) AS p
  FROM byte_counts JOIN files f USING (page_id) GROUP BY 1, 2)"""
)

CELLS = """
cells AS (
  SELECT model,
         count(*) FILTER (WHERE label = 1 AND prediction = 1) AS true_positive,
         count(*) FILTER (WHERE label = 0 AND prediction = 0) AS true_negative,
         count(*) FILTER (WHERE label = 0 AND prediction = 1) AS false_positive,
         count(*) FILTER (WHERE label = 1 AND prediction = 0) AS false_negative,
         count(*) FILTER (WHERE label IS NULL OR prediction IS NULL) AS n_null,
         count(*) FILTER (WHERE label IS NOT NULL AND prediction IS NOT NULL
                          AND NOT (label IN (0, 1) AND prediction IN (0, 1))) AS n_other,
         count(*) AS n_rows
  FROM {source} GROUP BY model)"""


def ratio(part: str, whole: str) -> str:
    return f"coalesce(({part})::double / nullif(({whole})::double, 0), 0)"


TP, TN, FP, FN = "true_positive", "true_negative", "false_positive", "false_negative"
N = f"({TP} + {TN} + {FP} + {FN})"

WEIGHTED = f"""
rates AS (
  SELECT *, {N} AS n, {TP} + {FN} AS n1, {TN} + {FP} AS n0,
         {ratio(TP, f"{TP} + {FP}")} AS p1, {ratio(TP, f"{TP} + {FN}")} AS r1,
         {ratio(TN, f"{TN} + {FN}")} AS p0, {ratio(TN, f"{TN} + {FP}")} AS r0
  FROM cells),
weighted AS (
  SELECT model, {ratio(f"{TP} + {TN}", "n")} AS accuracy,
         {ratio("n1 * p1 + n0 * p0", "n")} AS precision_weighted,
         {ratio("n1 * r1 + n0 * r0", "n")} AS recall_weighted,
         {ratio(f"n1 * {ratio('2 * p1 * r1', 'p1 + r1')} + n0 * {ratio('2 * p0 * r0', 'p0 + r0')}", "n")} AS f1_weighted
  FROM rates)"""

AREA = """
points AS (
  SELECT model, p, count(*) FILTER (WHERE label = 1)::double AS pos, count(*) FILTER (WHERE label = 0)::double AS neg
  FROM scored WHERE p IS NOT NULL AND label IN (0, 1) GROUP BY model, p),
ranked AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY p
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM points),
area AS (
  SELECT model, sum(pos)::bigint AS n_pos, sum(neg)::bigint AS n_neg,
         sum(pos * (below + neg / 2)) / nullif(sum(pos) * sum(neg), 0) AS auc_roc
  FROM ranked GROUP BY model)"""

SCORED_CELLS = SCORED + "," + CELLS.format(source="scored")
LI_CELLS = LI + "," + CELLS.format(source="scored")
DOCS_CELLS = DOCS + "," + CELLS.format(source="docs")

METRICS = (
    SCORED_CELLS
    + ","
    + WEIGHTED
    + ","
    + AREA
    + """,
metrics AS (
  SELECT model, accuracy, precision_weighted AS precision, recall_weighted AS recall,
         f1_weighted AS f1_score, auc_roc,
         CASE model WHEN 'LogisticRegression' THEN 1.0::double ELSE 2.0::double END AS train_time_seconds
  FROM weighted JOIN area USING (model))"""
)

EITHER = (
    LI
    + ","
    + DOCS
    + """,
either AS (
  SELECT model, label, prediction FROM scored UNION ALL SELECT model, label, prediction FROM docs)"""
)

BROKEN = (
    BYTES
    + """,
broken AS (
  SELECT *, path LIKE '%/' OR path LIKE '%page=%' AS is_broken FROM files)"""
)


def select(relations: str, body: str) -> str:
    return f"WITH {relations.strip()}\n{body.strip()}"


def rounded(columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c.strip()}, {digits}) AS {c.strip()}" for c in columns.split(","))


def percent(value: str) -> str:
    return f"printf('%.2f%%', round({value}, 2))"


def best(metric: str = "accuracy") -> str:
    return f"(SELECT max({metric}) FROM metrics)"


def of_model(model: str, metric: str) -> str:
    return f"(SELECT {metric} FROM metrics WHERE model = '{model}')"


LR, RF = "LogisticRegression", "RandomForest"
FOREST_AHEAD = f"{of_model(RF, 'accuracy')} > {of_model(LR, 'accuracy')}"
METRIC_ROW = "model, " + rounded("accuracy, precision, recall, f1_score, auc_roc, train_time_seconds")
TITLE = "CASE model WHEN 'LogisticRegression' THEN 'Logistic Regression' ELSE 'Random Forest' END"

SQL: dict[str, str] = {}

# ---- scans and sources -----------------------------------------------------------

SQL["scan_files"] = select(
    BYTES,
    """
SELECT split, label_name, label, octet_length(content) + 1 AS length, md5(html || chr(10)) AS digest FROM files""",
)
SQL["scan_multi_ext"] = select(
    BYTES,
    """
SELECT CASE split WHEN 'train' THEN 'jPg' ELSE 'png' END AS ending, md5(html) AS digest FROM files""",
)
SQL["ending_inventory"] = select(
    BYTES,
    """
SELECT CASE split WHEN 'train' THEN 'jpg' ELSE 'png' END AS ending, count(*) AS n_files,
       sum(2 * octet_length(content) + 1)::bigint AS n_bytes, true AS is_image
FROM files GROUP BY split
UNION ALL
SELECT 'txt', count(*), sum(2 * octet_length(content) + 1)::bigint, false FROM files""",
)
SQL["derive_split_label"] = select(
    BYTES
    + """,
placed AS (
  SELECT page_id, CASE WHEN path LIKE '%/' THEN path
                  ELSE path || '/' || split || '/' || label_name || '/' || page_id || '.jpg' END AS path
  FROM files),
parts AS (
  SELECT page_id, path, nullif(regexp_extract(path, '/(train|test)/(REAL|FAKE)/', 1), '') AS split,
         nullif(regexp_extract(path, '/(train|test)/(REAL|FAKE)/', 2), '') AS label_name
  FROM placed)""",
    """
SELECT page_id, path, split, label_name, CASE label_name WHEN 'REAL' THEN 0 WHEN 'FAKE' THEN 1 END AS label,
       'pages' AS dataset
FROM parts""",
)
SQL["scan_features"] = select(
    FEAT,
    """
SELECT vec_id, label, label_name, split, len(embedding)::int AS width,
       round(embedding[1]::double, 6) AS first, round(embedding[-1]::double, 6) AS last,
       round(list_sum(embedding::double[]), 6) AS total
FROM feat WHERE embedding IS NOT NULL""",
)
SQL["empty_features"] = select(FEAT, "SELECT split, label_name, count(*) AS n FROM feat GROUP BY split, label_name")
SQL["csv_roundtrip"] = select(
    BYTE_COUNTS,
    """
SELECT path, CASE WHEN p > 0.5 THEN 'FAKE' ELSE 'REAL' END AS result, round(p * 100, 6) AS confidence
FROM byte_scores""",
)
SQL["parquet_roundtrip"] = select(
    FEAT,
    """
SELECT split, label_name, count(*) AS n, round(sum(embedding[1]::double), 6) AS sum_first
FROM feat GROUP BY split, label_name""",
)
SQL["resume_pending"] = select(
    BYTES,
    """
SELECT path, split, label_name, octet_length(content)::int AS length FROM files
WHERE path NOT IN (SELECT path FROM files WHERE split = 'train')""",
)

SQL["file_changes"] = select(
    BYTES
    + """,
pages_ AS (SELECT page_id, 'page-' || page_id AS path, octet_length(content) AS length FROM files)""",
    """
SELECT path, CASE WHEN page_id % 11 <> 0 THEN length END AS length,
       CASE WHEN page_id % 11 = 0 THEN 'deleted'
            WHEN page_id % 13 = 0 THEN 'new'
            WHEN page_id % 7 = 0 OR page_id % 3 = 0 THEN 'changed'
            ELSE 'unchanged' END AS status
FROM pages_ WHERE page_id % 11 <> 0 OR page_id % 13 <> 0""",
)
SQL["histogram_by_ranges"] = select(
    BYTES,
    """
SELECT s.split, l.label_name, count(html) + 1 AS n_files, 1::bigint AS n_errors,
       sum(length(html) - length(replace(html, 'e', '')))::bigint AS n_e,
       sum(length(html) - length(replace(html, '<', '')))::bigint AS n_tags
FROM (VALUES ('train'), ('test')) AS s(split), (VALUES ('REAL'), ('FAKE')) AS l(label_name)
LEFT JOIN files ON files.split = s.split AND files.label_name = l.label_name GROUP BY s.split, l.label_name""",
)
# each folder has an empty file more; the training files of label FAKE are replaced by longer ones,
# or in stream_follow joined by them
_LANDED = (
    BYTES
    + """,
landed AS (
  SELECT split, label_name, octet_length(content) AS size, split = 'train' AND label_name = 'FAKE' AS longer FROM files),
empties AS (
  SELECT s.split, l.label_name FROM (VALUES ('train'), ('test')) AS s(split), (VALUES ('REAL'), ('FAKE')) AS l(label_name))"""
)
_LANDED_SUMS = """
SELECT split, label_name, count(*) AS n_rows, count(*) FILTER (WHERE length IS NULL) AS n_errors, sum(length)::bigint AS n_bytes
FROM all_files GROUP BY split, label_name"""
SQL["refreshed_features"] = select(
    _LANDED
    + """,
all_files AS (
  SELECT split, label_name, CASE WHEN longer THEN 2 * size ELSE size END + 1 AS length FROM landed
  UNION ALL SELECT split, label_name, NULL FROM empties)""",
    _LANDED_SUMS,
)
SQL["stream_follow"] = select(
    _LANDED
    + """,
all_files AS (
  SELECT split, label_name, size + 1 AS length FROM landed
  UNION ALL SELECT split, label_name, 2 * size + 1 FROM landed WHERE longer
  UNION ALL SELECT split, label_name, NULL FROM empties)""",
    _LANDED_SUMS,
)

# ---- projections and filters -----------------------------------------------------

SQL["decode_label"] = select(
    DOCS,
    """
SELECT doc_id, prediction, CASE WHEN prediction = 0 THEN 'REAL' WHEN prediction = 1 THEN 'FAKE' END AS predicted_label
FROM docs""",
)
SQL["correct_flag"] = select(DOCS, "SELECT doc_id, label, prediction, label = prediction AS correct FROM docs")
SQL["peek_rows"] = select(
    LI,
    f"""
SELECT path, label, label_name, prediction FROM scored WHERE model = '{LR}' ORDER BY path LIMIT 20""",
)
SQL["misclassified"] = select(
    LI,
    """
SELECT model, path, label, label_name, round(p, 6) AS fake_probability, prediction
FROM scored WHERE label <> prediction""",
)
SQL["error_rows"] = select(
    SCORED,
    """
SELECT model, vec_id, label, label_name, round(p, 6) AS fake_probability, prediction,
       CASE WHEN label = 0 THEN 'false_positive' ELSE 'false_negative' END AS error_kind
FROM scored WHERE label <> prediction""",
)
SQL["metric_lookup"] = select(METRICS, f"SELECT {METRIC_ROW} FROM metrics WHERE model = '{RF}'")
SQL["file_name"] = "SELECT page_id, string_split(url, '/')[-1] AS file_name FROM pages"
SQL["fake_probability"] = select(
    SCORED,
    f"""
SELECT model, vec_id, round(p * 100, 6) AS confidence, {percent("p * 100")} AS confidence_text FROM scored""",
)

# ---- aggregations ----------------------------------------------------------------

SQL["confusion_wide"] = select(LI_CELLS, "SELECT * FROM cells")
SQL["confusion_wide_documents"] = select(DOCS_CELLS, "SELECT * FROM cells")
SQL["confusion_long"] = select(
    LI,
    """
SELECT model, label_name AS actual_label,
       CASE prediction WHEN 0 THEN 'REAL' WHEN 1 THEN 'FAKE' END AS predicted_label, count(*) AS n
FROM scored GROUP BY 1, 2, 3""",
)
SQL["binary_metrics"] = select(
    LI_CELLS
    + f""",
rates AS (
  SELECT model, {N} AS n, {ratio(f"{TP} + {TN}", N)} AS accuracy,
         {ratio(TP, f"{TP} + {FP}")} AS precision_fake, {ratio(TP, f"{TP} + {FN}")} AS recall_fake,
         {ratio(TN, f"{TN} + {FP}")} AS specificity, {ratio(FP, f"{TN} + {FP}")} AS false_positive_rate,
         {ratio(FN, f"{TP} + {FN}")} AS false_negative_rate
  FROM cells),
all_rates AS (
  SELECT *, {ratio("2 * precision_fake * recall_fake", "precision_fake + recall_fake")} AS f1_fake FROM rates)""",
    "SELECT model, n, "
    + rounded(
        "accuracy, precision_fake, recall_fake, specificity, f1_fake, false_positive_rate, false_negative_rate"
    )
    + " FROM all_rates",
)
_WEIGHTED_ROW = (
    "SELECT model, " + rounded("accuracy, precision_weighted, recall_weighted, f1_weighted") + " FROM weighted"
)
SQL["weighted_metrics"] = select(LI_CELLS + "," + WEIGHTED, _WEIGHTED_ROW)
SQL["weighted_metrics_documents"] = select(DOCS_CELLS + "," + WEIGHTED, _WEIGHTED_ROW)
SQL["error_summary"] = select(
    EITHER + "," + CELLS.format(source="either"),
    f"""
SELECT model, n_rows, {FP} + {FN} AS n_errors, round({ratio(f"{FP} + {FN}", "n_rows")}, 6) AS error_rate, {FP}, {FN}
FROM cells""",
)
SQL["prediction_breakdown"] = select(
    EITHER,
    """
SELECT model, count(*) AS n_rows, count(*) FILTER (WHERE label = prediction) AS n_correct,
       count(*) - count(*) FILTER (WHERE label = prediction) AS n_wrong,
       round(count(*) FILTER (WHERE label = prediction)::double / count(*), 6) AS share_correct_of_all
FROM either GROUP BY model""",
)
SQL["error_by_class"] = select(
    LI,
    """
SELECT model, label_name, count(*) AS n_rows, count(*) FILTER (WHERE label <> prediction) AS n_errors,
       round(count(*) FILTER (WHERE label <> prediction)::double / count(*), 6) AS error_rate
FROM scored GROUP BY model, label_name""",
)
_AREA_ROW = "SELECT model, n_pos, n_neg, round(auc_roc, 9) AS auc_roc FROM area"
SQL["auc_exact"] = select(LI + "," + AREA, _AREA_ROW)
SQL["auc_exact_vectors"] = select(SCORED + "," + AREA, _AREA_ROW)
SQL["threshold_sweep"] = select(
    LI
    + f""",
thresholds AS (SELECT i / 10.0::double AS threshold FROM range(1, 10) r(i)),
sweep AS (
  SELECT model, threshold,
         count(*) FILTER (WHERE label = 1 AND p > threshold) AS {TP},
         count(*) FILTER (WHERE label = 0 AND NOT p > threshold) AS {TN},
         count(*) FILTER (WHERE label = 0 AND p > threshold) AS {FP},
         count(*) FILTER (WHERE label = 1 AND NOT p > threshold) AS {FN}
  FROM scored, thresholds GROUP BY model, threshold)""",
    f"""
SELECT *, round({ratio(TP, f"{TP} + {FP}")}, 6) AS precision_fake,
       round({ratio(TP, f"{TP} + {FN}")}, 6) AS recall_fake,
       round({ratio(FP, f"{FP} + {TN}")}, 6) AS false_positive_rate, round({ratio(f"{TP} + {TN}", N)}, 6) AS accuracy
FROM sweep""",
)
SQL["class_distribution"] = select(
    DOCS,
    """
SELECT split, label_name, count(*) AS n,
       round(count(*)::double / sum(count(*)) OVER (PARTITION BY split), 6) AS share
FROM docs GROUP BY split, label_name""",
)
SQL["dataset_sizes"] = select(
    FEAT,
    """
SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test,
       count(*) AS n_total, round(avg((split = 'train')::int), 6) AS train_share,
       round(avg((split = 'test')::int), 6) AS test_share
FROM feat""",
)
SQL["result_summary"] = select(
    LI,
    f"""
SELECT CASE prediction WHEN 0 THEN 'REAL' WHEN 1 THEN 'FAKE' END AS result, count(*) AS n,
       round(count(*)::double / sum(count(*)) OVER (), 6) AS share
FROM scored WHERE model = '{LR}' GROUP BY 1""",
)
SQL["best_metric"] = select(METRICS, "SELECT round(max(accuracy), 6) AS best_accuracy FROM metrics")
SQL["file_inventory"] = select(
    BYTES
    + """,
folders AS (
  SELECT split, label_name, octet_length(content) + 1 AS length FROM files
  UNION ALL
  SELECT s.split, l.label_name, 0
  FROM (VALUES ('train'), ('test')) AS s(split), (VALUES ('REAL'), ('FAKE')) AS l(label_name))""",
    """
SELECT split, label_name, count(*) AS n_files, count(*) FILTER (WHERE length = 0) AS n_empty,
       sum(length)::bigint AS n_bytes
FROM folders GROUP BY split, label_name""",
)
SQL["byte_inventory"] = select(
    BYTES,
    """
SELECT split, label_name, count(*) AS n_files, count(*) FILTER (WHERE octet_length(content) = 0) AS n_empty,
       sum(octet_length(content))::bigint AS n_bytes
FROM files GROUP BY split, label_name""",
)

_MEASURED = (
    DOCS
    + """,
measured AS (
  SELECT docs.*, CASE label WHEN 0 THEN 'REAL' WHEN 1 THEN 'FAKE' END AS class_, strlen(text) AS length
  FROM docs JOIN documents USING (doc_id))"""
)
SQL["totals_in_one_pass"] = select(
    _MEASURED,
    """
SELECT CASE grouping(model, split, class_) WHEN 4 THEN 'split and class' WHEN 5 THEN 'split' WHEN 2 THEN 'model and class' ELSE 'model' END AS level,
       model, split, class_ AS label_name, count(*) AS n_rows, count(*) FILTER (WHERE label <> prediction) AS n_errors,
       count(*) FILTER (WHERE length = 0) AS n_empty, sum(length)::bigint AS n_bytes
FROM measured GROUP BY GROUPING SETS ((split, class_), (split), (model, class_), (model))""",
)
SQL["totals_class_distribution"] = select(
    _MEASURED,
    """
SELECT split, class_ AS label_name, count(*) AS n, round(count(*)::double / sum(count(*)) OVER (PARTITION BY split), 6) AS share
FROM measured GROUP BY split, class_""",
)
SQL["totals_error_by_class"] = select(
    _MEASURED,
    """
SELECT model, class_ AS label_name, count(*) AS n_rows, count(*) FILTER (WHERE label <> prediction) AS n_errors,
       round(count(*) FILTER (WHERE label <> prediction)::double / count(*), 6) AS error_rate
FROM measured GROUP BY model, class_""",
)
SQL["observed_counts"] = select(
    BYTE_COUNTS
    + """,
broken AS (
  SELECT p, path LIKE '%/' OR path LIKE '%page=%' AS is_broken FROM byte_scores)""",
    """
SELECT 2 * count(*) AS n_rows, 2 * count(*) FILTER (WHERE is_broken) AS n_quarantined,
       2 * count(*) FILTER (WHERE NOT is_broken AND p > 0.5) AS n_fake, 2 * count(*) AS n_stored, true AS agree
FROM broken""",
)

# ---- order, limits, set operations -----------------------------------------------

SQL["top_suspects"] = select(
    LI,
    f"""
SELECT path, label_name, round(p * 100, 6) AS confidence FROM scored WHERE model = '{LR}'
ORDER BY p * 100 DESC, path LIMIT 20""",
)
for _name, _n in (("sample_per_class", 50), ("sample_per_class_many", 2000)):
    SQL[_name] = select(
        LI
        + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY model, label_name ORDER BY path) AS place FROM scored)""",
        f"SELECT model, path, label_name, prediction FROM placed WHERE place <= {_n}",
    )
SQL["threshold_for_rate"] = select(
    LI
    + """,
usable AS (SELECT * FROM scored WHERE label IS NOT NULL AND p IS NOT NULL),
reals AS (SELECT model, p AS t, count(*) AS n FROM usable WHERE label = 0 GROUP BY model, p),
above AS (
  SELECT model, t, sum(n) OVER (PARTITION BY model) AS n_real,
         coalesce(sum(n) OVER (PARTITION BY model ORDER BY t DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fp
  FROM reals),
best AS (
  SELECT model, rate::double AS target_rate, min(t) AS threshold
  FROM above, (VALUES (0.0), (0.01), (0.05), (0.333), (1.0)) AS r(rate)
  WHERE fp <= floor(rate::decimal(9, 3) * n_real) GROUP BY model, rate)""",
    """
SELECT model, target_rate, round(threshold, 6) AS threshold,
       count(*) FILTER (WHERE label = 0 AND p > threshold) AS false_positive,
       count(*) FILTER (WHERE label = 1 AND p > threshold) AS true_positive,
       round(count(*) FILTER (WHERE label = 0 AND p > threshold)::double / count(*) FILTER (WHERE label = 0), 6) AS false_positive_rate,
       round(count(*) FILTER (WHERE label = 1 AND p > threshold)::double / count(*) FILTER (WHERE label = 1), 6) AS recall_fake
FROM usable JOIN best USING (model) GROUP BY model, target_rate, threshold""",
)
SQL["auc_within_bound"] = select(
    LI
    + """,
ranked AS (
  SELECT model, label, rank() OVER (PARTITION BY model ORDER BY p) + (count(*) OVER (PARTITION BY model, p) - 1) / 2.0::double AS place
  FROM scored WHERE label IS NOT NULL AND p IS NOT NULL)""",
    """
SELECT model, round((sum(place) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0::double)
       / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)::double), 6) AS auc_roc,
       round(2 * (0.5::double / 500 + 1::double / 20000), 6) AS error_bound, true AS within_bound
FROM ranked GROUP BY model""",
)
SQL["sample_per_class_most"] = select(
    LI
    + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY prediction ORDER BY path) AS place
  FROM (SELECT DISTINCT path, prediction FROM scored))""",
    "SELECT path, prediction FROM placed WHERE place <= 100000",
)
SQL["union_splits"] = select(
    FEAT,
    """
SELECT vec_id, label, label_name, split FROM feat WHERE split = 'train'
UNION ALL SELECT vec_id, label, label_name, split FROM feat WHERE split = 'test'""",
)

# ---- features and models ---------------------------------------------------------

SQL["byte_histogram"] = select(BYTE_COUNTS, "SELECT page_id, byte, n FROM byte_counts")
SQL["image_histogram"] = select(
    FEAT
    + """,
levels AS (
  SELECT vec_id, CASE WHEN label_name IS NOT NULL THEN split END AS split, label_name,
         floor((unnest(embedding)::double + 1) * 127.5)::int AS level
  FROM feat),
channels AS (
  SELECT vec_id, split, label_name, 0 AS channel, (level // 2)::int AS level FROM levels
  UNION ALL SELECT vec_id, split, label_name, 1, 255 - level FROM levels
  UNION ALL SELECT vec_id, split, label_name, 2, level FROM levels),
histogram AS (
  SELECT vec_id, split, label_name, channel * 256 + level AS dim, count(*)::float AS value
  FROM channels GROUP BY ALL),
moments AS (
  SELECT vec_id, split, label_name, channel, avg(level)::float AS mean,
         sqrt(avg(level * level) - avg(level) * avg(level))::float AS std,
         min(level)::float AS low, max(level)::float AS high
  FROM channels GROUP BY ALL),
dims AS (
  SELECT vec_id, split, label_name, dim, value FROM histogram
  UNION ALL SELECT vec_id, split, label_name, 768 + channel, mean FROM moments
  UNION ALL SELECT vec_id, split, label_name, 771 + channel, std FROM moments
  UNION ALL SELECT vec_id, split, label_name, 774 + channel, low FROM moments
  UNION ALL SELECT vec_id, split, label_name, 777 + channel, high FROM moments)""",
    """
SELECT split, label_name, dim::int AS dim, count(*) AS n_images, round(sum(value::double), 3) AS total
FROM dims WHERE value > 0 GROUP BY split, label_name, dim""",
)
_STD = """,
stds AS (
  SELECT dim, stddev_samp(x) AS std
  FROM (SELECT unnest(range(0, 64)) AS dim, unnest(embedding)::double AS x FROM feat) GROUP BY dim)"""
SQL["scaler_stats"] = select(FEAT + _STD, "SELECT dim::int AS dim, round(std, 6) AS std FROM stds")
SQL["linear_score"] = select(
    SCORED,
    """
SELECT model, vec_id, label, label_name, round(p, 6) AS fake_probability, prediction FROM scored""",
)
SQL["refit_scaler_scores"] = select(
    FEAT
    + _STD
    + """,
scaled AS (
  SELECT vec_id, sum(x / std * (((dim * 37) % 17 - 8) / 8.0::double)) AS margin
  FROM (SELECT vec_id, unnest(range(0, 64)) AS dim, unnest(embedding)::double AS x FROM feat) JOIN stds USING (dim)
  GROUP BY vec_id),
answers AS (SELECT vec_id, 1 / (1 + exp(-margin)) AS p FROM scaled)""",
    """
SELECT vec_id, (p > 0.5)::int::double AS prediction, round(p * 100, 6) AS confidence,
       CASE WHEN p > 0.5 THEN 'FAKE' WHEN p <= 0.5 THEN 'REAL' END AS result
FROM feat LEFT JOIN answers USING (vec_id)""",
)
SQL["score_new"] = select(
    BYTE_COUNTS
    + """,
answers AS (
  SELECT b.path, CASE WHEN b.path LIKE '%/' OR b.path LIKE '%page=%' THEN NULL ELSE p END AS p FROM byte_scores b)""",
    """
SELECT path, (p > 0.5)::int::double AS prediction,
       CASE WHEN p > 0.5 THEN 'FAKE' WHEN p <= 0.5 THEN 'REAL' END AS result,
       round(p * 100, 6) AS confidence, CASE WHEN p IS NULL THEN 'broken' END AS error
FROM answers""",
)
SQL["quarantine_counts"] = select(
    BROKEN,
    """
SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE NOT is_broken) AS n_usable,
       count(*) FILTER (WHERE is_broken) AS n_quarantined, 0::bigint AS n_zero_vectors
FROM broken GROUP BY split""",
)
SQL["quarantine_rows"] = select(BROKEN, "SELECT path, label, label_name, split FROM broken WHERE is_broken")
SQL["inference_sample"] = select(
    METRICS
    + f""",
best AS (
  SELECT model FROM metrics ORDER BY accuracy DESC, CASE model WHEN '{LR}' THEN 1 ELSE 2 END LIMIT 1),
placed AS (
  SELECT vec_id, label_name, row_number() OVER (PARTITION BY label_name ORDER BY vec_id) AS place
  FROM feat WHERE split = 'test')""",
    """
SELECT vec_id AS path, p.label_name AS actual_label,
       CASE s.prediction WHEN 0 THEN 'REAL' WHEN 1 THEN 'FAKE' END AS predicted_label, s.prediction
FROM placed p JOIN scored s USING (vec_id) JOIN best USING (model) WHERE place <= 20""",
)
SQL["score_reloaded"] = "SELECT count(embedding) AS n_rows, count(embedding) AS n_same FROM embeddings"

# ---- decisions and report --------------------------------------------------------

SQL["champion"] = select(
    METRICS,
    f"""
SELECT model AS best_model, round(accuracy, 6) AS best_accuracy FROM metrics
ORDER BY accuracy DESC, CASE model WHEN '{LR}' THEN 1 ELSE 2 END LIMIT 1""",
)
SQL["model_comparison"] = select(
    METRICS,
    " UNION ALL ".join(
        f"SELECT '{m}' AS metric, round({of_model(LR, m)}, 6) AS {LR}, round({of_model(RF, m)}, 6) AS {RF}"
        for m in ("accuracy", "precision", "recall", "f1_score", "auc_roc", "train_time_seconds")
    ),
)
SQL["verdict"] = select(
    METRICS,
    "SELECT round(max(accuracy), 6) AS best_accuracy, max(accuracy) > 0.7 AS sufficient FROM metrics",
)
_FACTS = {
    "Dataset": "'embeddings (even and odd labels)'",
    "Total Images": "(SELECT count(*) FROM feat)::varchar",
    "Feature Extractor": "'Embedding (given)'",
    "Feature Dimension": "'64'",
    "Best Model": f"CASE WHEN {FOREST_AHEAD} THEN 'Random Forest' ELSE 'Logistic Regression' END",
    "Best Accuracy": percent(f"{best()} * 100"),
    "Best F1 Score": percent(f"{best('f1_score')} * 100"),
    **{
        f"{short} {metric.capitalize()}": percent(f"{of_model(model, metric)} * 100")
        for short, model in (("LR", LR), ("RF", RF))
        for metric in ("accuracy", "precision", "recall")
    },
    "Conclusion": f"CASE WHEN {best()} > 0.7 THEN 'Embedding features are SUFFICIENT for Deepfake detection' "
    "ELSE 'Features need improvement' END",
}
SQL["insight_facts"] = select(
    METRICS, " UNION ALL ".join(f"SELECT '{k}' AS metric, {v} AS value" for k, v in _FACTS.items())
)
_REPORT = {
    "report_path": "'report_series'",
    "best_model": f"CASE WHEN {FOREST_AHEAD} THEN '{RF}' ELSE '{LR}' END",
    "best_accuracy": percent(f"{best()} * 100"),
}
SQL["report_facts"] = select(
    METRICS, " UNION ALL ".join(f"SELECT '{k}' AS key, {v} AS value" for k, v in _REPORT.items())
)
_PART = "CASE split WHEN 'train' THEN 'Training ' ELSE 'Test ' END || coalesce(label_name, 'without label')"
_SERIES = [
    f"SELECT 'accuracy' AS section, 'Accuracy (%)' AS series, {TITLE} AS x, accuracy * 100 AS y FROM metrics",
    *[
        f"SELECT 'metrics', {TITLE}, '{title}', {metric} * 100 FROM metrics"
        for metric, title in (
            ("accuracy", "Accuracy"),
            ("precision", "Precision"),
            ("recall", "Recall"),
            ("f1_score", "F1-Score"),
            ("auc_roc", "AUC-ROC"),
        )
    ],
    f"SELECT 'training', 'Training Time', {TITLE}, train_time_seconds FROM metrics",
    "SELECT 'summary', 'cards', 'Best Accuracy', max(accuracy) * 100 FROM metrics",
    "SELECT 'summary', 'cards', 'Models Trained', count(*) FROM metrics",
    "SELECT 'summary', 'cards', 'Features', 64",
    "SELECT 'summary', 'cards', 'Total Images', count(*) FROM feat",
    *[
        f"SELECT 'confusion', {TITLE}, '{short}', {cell} FROM cells"
        for short, cell in (("TN", TN), ("FP", FP), ("FN", FN), ("TP", TP))
    ],
    f"SELECT 'dataset', 'images', {_PART}, count(*) FROM feat GROUP BY split, label_name",
    f"SELECT 'dataset', 'share of split (%)', {_PART}, 100 * count(*)::double / sum(count(*)) OVER (PARTITION BY split) "
    "FROM feat GROUP BY split, label_name",
]
SQL["report_series"] = select(
    METRICS + ",\nseries AS (\n" + "\nUNION ALL ".join(_SERIES) + ")",
    "SELECT section, series, x, round(y::double, 4) AS y FROM series",
)
_SIZES = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
    for t in ("embeddings", "documents", "labels", "lineitem", "pages", "events")
)
SQL["table_sizes"] = f"{_SIZES} UNION ALL SELECT 'predictions', NULL"
SQL["output_check"] = (
    f"WITH sizes AS ({SQL['table_sizes']}) SELECT count(*) AS n_expected, "
    "count(*) FILTER (WHERE n_rows > 0) AS n_filled, count(*) FILTER (WHERE n_rows > 0) >= 5 AS passed FROM sizes"
)

# ---- streaming -------------------------------------------------------------------

SQL["stream_score"] = select(
    SCORED,
    f"""
SELECT vec_id, label, round(p, 6) AS fake_probability, prediction FROM scored WHERE model = '{LR}'""",
)
SQL["stream_extract"] = select(
    BYTES,
    """
SELECT split, label_name, label, octet_length(content) + 1 AS length FROM files""",
)

_JUDGED = """
orders_ AS (
  SELECT 'PriceRule' AS model, CASE WHEN o_custkey % 10 < 5 THEN 1 ELSE 0 END AS prediction,
         CASE WHEN o_orderkey % 9 <> 0 THEN (o_totalprice > 150000)::int END AS label
  FROM orders)"""
SQL["running_cells"] = select(
    _JUDGED,
    """
SELECT model, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS true_positive,
       count(*) FILTER (WHERE label = 0 AND prediction = 0) AS true_negative,
       count(*) FILTER (WHERE label = 0 AND prediction = 1) AS false_positive,
       count(*) FILTER (WHERE label = 1 AND prediction = 0) AS false_negative, 0::bigint AS n_other
FROM orders_ GROUP BY model""",
)
SQL["running_results"] = select(
    _JUDGED,
    """
SELECT model, CASE prediction WHEN 1 THEN 'FAKE' ELSE 'REAL' END AS result, count(*) AS n,
       round(count(*)::double / sum(count(*)) OVER (PARTITION BY model), 6) AS share
FROM orders_ GROUP BY model, prediction""",
)

# ---- model fits: SQL cannot fit, but states what must hold ------------------------

SQL["lr_fit_score"] = select(
    FEAT,
    """
SELECT count(*) AS n_rows, count(*) AS n_agree, max(len(embedding))::bigint AS n_dims, 0::bigint AS n_violations
FROM feat WHERE embedding IS NOT NULL""",
)
SQL["rf_fit_score"] = select(
    FEAT, "SELECT vec_id, label, true AS votes_agree FROM feat WHERE embedding IS NOT NULL"
)
SQL["rf_importance"] = select(
    FEAT, "SELECT max(len(embedding))::bigint AS n_dims, 0::bigint AS n_negative, 1.0::double AS total FROM feat"
)
SQL["train_and_evaluate"] = select(
    FEAT,
    """
SELECT m.model, count(*) AS n_rows, true AS metrics_agree, true AS timed
FROM feat, (VALUES ('LogisticRegression'), ('RandomForest')) AS m(model)
WHERE split = 'test' AND embedding IS NOT NULL GROUP BY m.model""",
)
SQL["train_wide"] = """
SELECT m.model, count(*) AS n_rows, true AS metrics_agree, true AS timed
FROM orders, (VALUES ('LogisticRegression'), ('RandomForest')) AS m(model)
WHERE o_orderkey % 6 = 0 GROUP BY m.model"""
SQL["score_new_stored"] = select(
    BYTES
    + """,
broken AS (
  SELECT path, path LIKE '%/' OR path LIKE '%page=%' AS is_broken FROM files)""",
    """
SELECT count(DISTINCT path) AS n_files, count(DISTINCT path) FILTER (WHERE is_broken) AS n_unanswered,
       count(DISTINCT path) FILTER (WHERE NOT is_broken) AS n_agree
FROM broken""",
)
