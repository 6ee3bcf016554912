"""Ordered work: exact ROC area, threshold trade-offs, top rows, samples per class."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import ratio
from ..session import run_folder
from ..sources.tables import read_table, write_table

GROUP_LIMIT = 1000  # up to this n Spark cuts the groups of a window before it shuffles them


def auc_exact(
    predictions: DataFrame,
    score: str = "fake_probability",
    by: str = "model",
    buckets: int | None = None,
    counts: dict[str, Column] | None = None,
) -> DataFrame:
    """Area under the ROC curve from ranks, ties counted half; null with one class only.

    Equal scores collapse to one row before anything is sorted. Those rows are dealt
    to ranges of scores, as many as there are shuffle partitions unless ``buckets``
    says otherwise, so a range holds its share of the rows at any size. Each range
    shrinks to a few sums, and the last step works on one row per range.
    ``counts`` are further count columns to carry along over all rows, which
    saves a second pass over the predictions.
    """
    counts = counts or {}
    usable = F.col("label").isin(0, 1) & ~F.isnan(score)
    ranked = predictions.withColumn("score", F.when(usable, F.col(score).cast("double")))
    has_score = F.col("score").isNotNull()
    points = ranked.groupBy(by, "score").agg(
        F.count_if(has_score & (F.col("label") == 1)).cast("double").alias("pos"),
        F.count_if(has_score & (F.col("label") == 0)).cast("double").alias("neg"),
        *[count.alias(name) for name, count in counts.items()],
    )
    # ranges follow one another, so their numbers order them; (by, score) is unique, so no tie crosses a border
    ranges = points.repartitionByRange(*([buckets] if buckets else []), by, "score")
    points = ranges.withColumn("bucket", F.spark_partition_id())

    lower_in_bucket = Window.partitionBy(by, "bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = (
        points.withColumn("below", F.coalesce(F.sum("neg").over(lower_in_bucket), F.lit(0.0)))
        .groupBy(by, "bucket")
        .agg(
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("wins"),
            *[F.sum(name).alias(name) for name in counts],
        )
    )
    lower_buckets = Window.partitionBy(by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        per_bucket.withColumn("below", F.coalesce(F.sum("neg").over(lower_buckets), F.lit(0.0)))
        .groupBy(by)
        .agg(
            F.sum("pos").cast("long").alias("n_pos"),
            F.sum("neg").cast("long").alias("n_neg"),
            F.try_divide(
                F.sum(F.col("wins") + F.col("pos") * F.col("below")), F.sum("pos") * F.sum("neg")
            ).alias("auc_roc"),
            *[F.sum(name).alias(name) for name in counts],
        )
    )


def threshold_sweep(
    predictions: DataFrame,
    thresholds: Sequence[float],
    score: str = "fake_probability",
    by: str = "model",
) -> DataFrame:
    """Confusion cells and rates when FAKE means a score above each threshold.

    A row is counted once, under the number of thresholds it exceeds; the
    cumulation runs on those few counts, not on rows times thresholds.
    """
    levels = sorted(set(map(float, thresholds)))
    exceeded = reduce(Column.__add__, [(F.col(score) > t).cast("int") for t in levels])
    counts = (
        predictions.where(F.col("label").isin(0, 1) & F.col(score).isNotNull() & ~F.isnan(score))
        .groupBy(by, "label", exceeded.alias("exceeded"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    steps = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(t).alias("threshold")) for i, t in enumerate(levels)])
    called_fake = F.col("exceeded") > F.col("step")
    fake = F.col("label") == 1

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    cells = (
        counts.select("*", F.inline(steps))
        .groupBy(by, "threshold")
        .agg(
            total(fake & called_fake).alias("true_positive"),
            total(~fake & ~called_fake).alias("true_negative"),
            total(~fake & called_fake).alias("false_positive"),
            total(fake & ~called_fake).alias("false_negative"),
        )
    )
    tp, tn, fp, fn = (
        F.col(c) for c in ("true_positive", "true_negative", "false_positive", "false_negative")
    )
    return cells.select(
        "*",
        ratio(tp, tp + fp).alias("precision_fake"),
        ratio(tp, tp + fn).alias("recall_fake"),
        ratio(fp, fp + tn).alias("false_positive_rate"),
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    )


def thresholds_for_rates(
    predictions: DataFrame,
    rates: Sequence[float],
    score: str = "fake_probability",
    by: str = "model",
    bins: int = 1000,
) -> DataFrame:
    """The smallest threshold of each model whose false-positive rate is at most each rate, and what it gives.

    A row is FAKE when its score lies above the threshold. Thresholds are scores of REAL rows, so ties are whole: the
    answer is the score of the REAL row behind as many others as the rate allows. It is found by counting: the
    scores that may hold it are cut into ``bins`` of equal width, and the one that does is cut again until it
    has a single value, which takes two or three passes of small sums; only those, ``bins`` for each model and rate,
    reach the driver. A model without REAL rows has no threshold. Rows without a label or a score take no part.
    """
    usable = predictions.where(F.col("label").isin(0, 1) & F.col(score).isNotNull() & ~F.isnan(score))
    usable = usable.select(F.col(by).alias("_by"), "label", F.col(score).cast("double").alias("_score"))
    real = usable.where("label = 0")
    spark = predictions.sparkSession
    sizes = real.groupBy("_by").agg(F.count("*").alias("n"), F.min("_score").alias("low"), F.max("_score").alias("high")).collect()
    searches = []
    for r in sizes:
        for rate in sorted(set(rates)):
            allowed = int(Decimal(str(rate)) * r["n"])
            # all may be above: the smallest score is as low as a threshold gets
            searches.append((r["_by"], float(rate), min(allowed, r["n"] - 1), 0, r["low"], r["high"]))
    kind = f"_by {usable.schema['_by'].dataType.simpleString()}, rate double, allowed long, above long, low double, high double"
    found = []
    while searches:
        found += [s for s in searches if s[4] == s[5]]
        searches = [s for s in searches if s[4] != s[5]]
        if not searches:
            break
        ranges = F.broadcast(spark.createDataFrame(searches, kind))  # a row for each model and rate
        at = (F.col("_score") - F.col("low")) / (F.col("high") - F.col("low")) * bins
        counts = (
            real.join(ranges, "_by").where("_score BETWEEN low AND high")
            .groupBy("_by", "rate", F.least(F.floor(at), F.lit(bins - 1)).alias("bin"))
            .agg(F.count("*").alias("n"), F.min("_score").alias("low"), F.max("_score").alias("high"))
        )
        per_search: dict[tuple, list] = {}
        for r in counts.collect():
            per_search.setdefault((r["_by"], r["rate"]), []).append(r)
        searches = [_bin_of(s, per_search[s[:2]]) for s in searches]
    # few rows, of which Spark does not know the size: a shuffle by model would send all its rows to one task
    table = F.broadcast(spark.createDataFrame(found, kind).select("_by", "rate", F.col("low").alias("threshold")))
    cells = usable.join(table, "_by").groupBy("_by", "rate", "threshold").agg(
        *[F.count_if((F.col("label") == y) & (F.col("_score") > F.col("threshold"))).alias(c) for c, y in (("false_positive", 0), ("true_positive", 1))],
        *[F.count_if(F.col("label") == y).alias(c) for c, y in (("n_real", 0), ("n_fake", 1))],
    )
    return cells.select(
        F.col("_by").alias(by), F.col("rate").alias("target_rate"), "threshold", "false_positive", "true_positive",
        ratio(F.col("false_positive"), F.col("n_real")).alias("false_positive_rate"),
        ratio(F.col("true_positive"), F.col("n_fake")).alias("recall_fake"),
    )


def _bin_of(search: tuple, counts: list) -> tuple:
    """The search, narrowed to the bin in which its row falls."""
    name, rate, allowed, above, _, _ = search
    for r in sorted(counts, key=lambda r: -r["bin"]):
        if above + r["n"] > allowed:
            return name, rate, allowed, above, r["low"], r["high"]
        above += r["n"]
    raise AssertionError("a search range holds its row")


def auc_sketched(
    predictions: DataFrame, score: str = "fake_probability", by: str = "model", points: int = 500, accuracy: int = 20_000
) -> DataFrame:
    """The area under the ROC curve from quantile sketches of both classes, with a bound of its error.

    One pass: a mergeable sketch of a class gives ``points`` quantiles, each off by at most 1 / ``accuracy`` of the
    class in rank, so the distribution they stand for is nowhere further from the true one than
    1 / (2 points) + 1 / accuracy. The area is linear in both distributions, so twice that bounds its error, ties
    counted half on both sides. No distinct scores are shuffled. Null with one class only.
    """
    usable = predictions.where(F.col("label").isin(0, 1) & F.col(score).isNotNull() & ~F.isnan(score))
    places = F.array(*[F.lit((i + 0.5) / points) for i in range(points)])
    sketch = [
        F.percentile_approx(F.when(F.col("label") == y, F.col(score)), places, accuracy).alias(c) for c, y in (("_real", 0), ("_fake", 1))
    ]
    both = usable.groupBy(by).agg(*sketch)
    as_points = both.where("_real IS NOT NULL AND _fake IS NOT NULL").select(
        by, F.inline(F.concat(*[F.transform(c, lambda x: F.struct(F.lit(y).alias("label"), x.alias("_point"))) for c, y in (("_real", 0), ("_fake", 1))]))
    )
    area = auc_exact(as_points, "_point", by).select(F.col(by).alias("_by"), F.col("auc_roc").alias("auc_sketched"))
    bound = F.lit(2 * (0.5 / points + 1 / accuracy)).alias("error_bound")
    return both.select(by).join(area, F.col(by).eqNullSafe(F.col("_by")), "left").select(by, "auc_sketched", bound)


def top_suspects(scored: DataFrame, n: int = 20, score: str = "confidence", key: str = "path") -> DataFrame:
    """The n rows most likely FAKE, ties broken by key."""
    return scored.orderBy(F.desc(score), key).limit(n)


def peek(rows: DataFrame, n: int = 20, key: str = "path") -> DataFrame:
    """The first n rows by key: the same ones on every run."""
    return rows.orderBy(key).limit(n)


def sample_per_class(
    rows: DataFrame,
    n: int = 50,
    label: str | Sequence[str] = "label_name",
    key: str = "path",
    splits: int = 48,
    few: int = 50_000,
) -> DataFrame:
    """The first n rows of each class by key, whatever the classes are; rows without a class are one more.

    A small n is a window whose first n rows Spark finds in each task before the shuffle, as long as no more than
    ``few`` rows of a class can meet that way. Otherwise:

    Each class's n-th key is found by counting, never by sorting: some keys, drawn by a hash, cut what may hold the
    n-th row into about ``splits`` ranges, the rows of each are counted before anything is shuffled, and the range in
    which the n-th falls is cut again, until it has ``few`` rows. Then all rows up to that range are taken by a
    filter, and only the rows of the last range are put in order. So no task gets more than ``few`` rows of a class,
    at any n, and a pass reads classes and keys only: the rows are stored once, however long it took to make them.

    Null keys come first, and rows of equal keys go by a hash of all their columns.
    """
    by = [label] if isinstance(label, str) else list(label)
    place = F.struct(F.col(key).isNotNull().alias("known"), F.col(key).alias("key"), F.xxhash64(*rows.columns).alias("tie"))
    keyed = rows.withColumns({"_class": F.struct(*by), "_at": place})
    nth = F.row_number().over(Window.partitionBy("_class").orderBy("_at"))
    if n <= GROUP_LIMIT and n * rows.rdd.getNumPartitions() <= few:
        return keyed.withColumn("_nth", nth).where(F.col("_nth") <= n).select(*rows.columns)
    folder = run_folder(rows.sparkSession, "sampled-rows")
    write_table(keyed, folder)
    keyed = read_table(rows.sparkSession, folder, keyed.schema)
    cuts = _cuts(keyed.select("_class", "_at"), n, splits, few)
    marked = keyed.join(cuts.withColumnRenamed("_class", "_of"), F.col("_class").eqNullSafe(F.col("_of")))
    taken = F.col("rest").isNull() | F.coalesce(F.col("_at") <= F.col("low"), F.lit(False))
    last = ~taken & F.coalesce(F.col("_at") <= F.col("high"), F.lit(True))
    ordered = marked.where(last).withColumn("_nth", nth).where("_nth <= rest")
    return marked.where(taken).select(*rows.columns).unionByName(ordered.select(*rows.columns))


def _cuts(keyed: DataFrame, n: int, splits: int, few: int) -> DataFrame:
    """_class, low, high, rest: rows up to ``low`` are taken, and the first ``rest`` of those up to ``high``.

    Null bounds are open; a null ``rest`` takes the whole class. One small row for each class.
    """
    spark = keyed.sparkSession
    none = F.lit(None).cast(keyed.schema["_at"].dataType)
    sizes = keyed.groupBy("_class").agg(F.count(F.lit(1)).alias("inside"))
    state = sizes.select(
        "_class", none.alias("low"), none.alias("high"), F.lit(0).cast("long").alias("before"), "inside", F.lit(False).alias("equal")
    )
    found: list[DataFrame] = []
    while True:
        folder = run_folder(spark, "class-cuts")
        write_table(state, folder)
        state = read_table(spark, folder, state.schema)
        whole = F.col("high").isNull() & (F.col("before") + F.col("inside") <= n)
        exact = ~whole & (F.col("before") + F.col("inside") == n)
        done = whole | exact | F.col("equal") | (F.col("inside") <= few)
        low = F.when(exact, F.col("high")).otherwise(F.col("low"))
        rest = F.when(exact, 0).when(~whole, F.lit(n) - F.col("before"))
        found.append(state.where(done).select("_class", low.alias("low"), "high", rest.alias("rest")))
        to_cut = state.where(~done)
        if to_cut.isEmpty():
            return reduce(DataFrame.unionByName, found)
        state = _narrowed(keyed, to_cut, n, splits, len(found))


def _narrowed(keyed: DataFrame, state: DataFrame, n: int, splits: int, number: int) -> DataFrame:
    """The range of each class that holds its n-th row, cut at keys drawn from it."""
    bounds = state.withColumnRenamed("_class", "_of")
    above = F.col("low").isNull() | (F.col("_at") > F.col("low"))
    below = F.col("high").isNull() | (F.col("_at") <= F.col("high"))
    inside = keyed.join(bounds, F.col("_class").eqNullSafe(F.col("_of"))).where(above & below)

    draw = F.xxhash64("_at", F.lit(number)).bitwiseAND(F.lit(2**63 - 1)) / F.lit(2.0**63)
    drawn = F.when(draw < 8.0 * splits / F.col("inside"), F.col("_at"))
    keys = inside.groupBy("_of", "low", "high", "before", "inside").agg(
        F.min("_at").alias("first"), F.max("_at").alias("last"), F.sort_array(F.collect_set(drawn)).alias("drawn")
    )
    even = F.transform(
        F.sequence(F.lit(1), F.lit(splits)), lambda i: F.get("drawn", F.floor(i * F.size("drawn") / (splits + 1)).cast("int"))
    )
    cut = F.array_distinct(F.concat(F.array("first"), F.filter(even, lambda k: k.isNotNull())))
    keys = keys.withColumn("cut", cut).drop("drawn")
    folder = run_folder(keyed.sparkSession, "class-keys")
    write_table(keys, folder)
    keys = read_table(keyed.sparkSession, folder, keys.schema)

    ranges = keyed.join(keys, F.col("_class").eqNullSafe(F.col("_of"))).where(above & below)
    part = F.size(F.filter("cut", lambda k: k < F.col("_at")))
    counts = ranges.groupBy("_class", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("_class").orderBy("part"))
    counts = counts.withColumn("upto", upto).join(keys, F.col("_class").eqNullSafe(F.col("_of")))
    total = F.col("before") + F.col("upto")
    hit = counts.where((total >= n) & (total - F.col("n") < n))
    low = F.when(F.col("part") == 0, F.col("low")).otherwise(F.get("cut", F.col("part") - 1))
    high = F.coalesce(F.get("cut", F.col("part")), F.col("high"), F.col("last"))
    return hit.select(
        "_class", low.alias("low"), high.alias("high"), (total - F.col("n")).alias("before"), F.col("n").alias("inside"),
        (F.col("first") == F.col("last")).alias("equal"),
    )
