"""Listing by folders, and extraction that follows rewritten and deleted files."""

import os
import re

import pytest
from fixtures import png_tree
from pyspark.sql import functions as F

from pixelproof.functions.featurizers import byte_histogram
from pixelproof.functions.features import with_features
from pixelproof.plans import extract, ranges
from pixelproof.plans.extract import file_changes, quarantined, run_extraction
from pixelproof.schemas import FEATURES
from pixelproof.sources import files, listing


def test_listing_agrees_with_the_scan(spark, tmp_path):
    png_tree(tmp_path)
    root = tmp_path / "raw"
    (root / "train/REAL/with space+%41ü.png").write_bytes(b"x")
    (root / "train/REAL/deep/er").mkdir(parents=True)
    (root / "train/REAL/deep/er/e.PNG").write_bytes(b"yy")
    (root / "train/REAL/_hidden").mkdir()
    (root / "train/REAL/_hidden/f.png").write_bytes(b"z")
    (root / "train/REAL/.g.png").write_bytes(b"z")
    (root / "top.png").write_bytes(b"top")
    columns = ["path", "length", "modificationTime"]
    scanned = {tuple(r) for r in files.scan_files(spark, str(root)).select(*columns).collect()}
    for levels in (0, 1, 2, 5):
        rows = listing.list_files(spark, str(root), files.IMAGE_GLOB, levels).select(*columns).collect()
        assert {tuple(r) for r in rows} == scanned and len(rows) == len(scanned) == 15
    (root / "empty.png").write_bytes(b"")
    assert {r["path"].rsplit("/", 1)[1] for r in files.empty_files(spark, str(root)).collect()} == {"empty.png"}
    one = listing.list_files(spark, [str(root / "top.png"), str(root / "test")]).count()
    assert one == 7


def test_names_stay_out_of_the_plan(spark, tmp_path):
    """More files make no larger plan, and folders are listed by tasks of their own."""
    sizes = []
    for n in (3, 300):
        root = tmp_path / str(n)
        for folder in ("a", "b", "c"):
            (root / folder).mkdir(parents=True)
            for i in range(n):
                (root / folder / f"unmistakable{i}.jpg").write_bytes(b"")
        found = files.all_files(spark, str(root))
        plan = found._jdf.queryExecution().toString()
        assert "unmistakable" not in plan and found.rdd.getNumPartitions() == 4 and found.count() == 3 * n
        sizes.append(len(re.sub(r"\d+", "", plan)))
    assert abs(sizes[0] - sizes[1]) < 50


@pytest.mark.parametrize("glob, names", [
    ("*.{jpg,[pP][nN]g}", {"a.jpg", "b.png", "c.PNg"}), ("?.jpg", {"a.jpg"}), ("[!a].*", {"b.png", "c.PNg"}),
    (r"e\*.x", {"e*.x"}), ("d,.txt", {"d,.txt"}), ("*", {"a.jpg", "b.png", "c.PNg", "d,.txt", "e*.x"}),
])
def test_globs(glob, names):
    pattern = listing.name_pattern(glob)
    assert {n for n in ("a.jpg", "b.png", "c.PNg", "d,.txt", "e*.x") if pattern.fullmatch(n)} == names


def test_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="nowhere"):
        listing.list_files(spark, str(tmp_path / "nowhere")).count()


# ---- following files -------------------------------------------------------------------
def sums(table):
    return {r["path"].rsplit("/", 1)[1]: r["n"] for r in table.select("path", F.aggregate("features", F.lit(0.0), lambda a, x: a + x).alias("n")).collect()}


def age(path, seconds):
    stat = path.stat()
    os.utime(path, (stat.st_atime, stat.st_mtime + seconds))


def test_rewritten_deleted_and_unchanged_files(spark, tmp_path):
    folder, out = tmp_path / "raw/train/REAL", str(tmp_path / "features")
    other = tmp_path / "raw/test/FAKE"
    for f in (folder, other):
        f.mkdir(parents=True)
    for name, size in (("a", 4), ("b", 5), ("c", 6)):
        (folder / f"{name}.jpg").write_bytes(b"x" * size)
    (other / "d.jpg").write_bytes(b"x" * 7)

    def run(**more):
        return run_extraction(spark, str(tmp_path / "raw"), out, byte_histogram(), **more)

    assert sums(run()) == {"a.jpg": 4, "b.jpg": 5, "c.jpg": 6, "d.jpg": 7}
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "features").rglob("*.parquet")}
    (folder / "a.jpg").write_bytes(b"y" * 10)
    (folder / "b.jpg").unlink()
    assert sums(run()) == {"a.jpg": 10, "c.jpg": 6, "d.jpg": 7}
    untouched = [p for p in before if "split=test" in str(p)]
    assert untouched and all(p.exists() and p.stat().st_mtime_ns == before[p] for p in untouched)

    # same length, other time: read again; a partition whose files are all gone is removed
    (folder / "c.jpg").write_bytes(b"z" * 6)
    age(folder / "c.jpg", 5)
    (other / "d.jpg").unlink()
    again = run()
    assert sums(again) == {"a.jpg": 10, "c.jpg": 6}
    assert again.where("path LIKE '%c.jpg'").select(F.expr("features[ascii('z')]")).first()[0] == 6.0
    assert not list((tmp_path / "features").rglob("split=test/*/*.parquet"))
    log = extract.known_versions(spark, out).collect()
    assert {r["path"].rsplit("/", 1)[1]: r["length"] for r in log} == {"a.jpg": 10, "c.jpg": 6}


def test_run_that_stopped_before_its_log(spark, tmp_path, monkeypatch):
    """Rows whose versions were never logged are made again, once each."""
    png_tree(tmp_path)
    root, out = str(tmp_path / "raw"), str(tmp_path / "features")

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(extract, "log_versions", stop)
    with pytest.raises(KeyboardInterrupt):
        run_extraction(spark, root, out, byte_histogram())
    monkeypatch.undo()
    assert run_extraction(spark, root, out, byte_histogram(), trust_unknown=True).count() == 12
    assert extract.known_versions(spark, out).count() == 0
    done = run_extraction(spark, root, out, byte_histogram())
    assert done.count() == 12 == done.select("path").distinct().count() == extract.known_versions(spark, out).count()


def test_file_larger_than_a_row_is_quarantined(spark, tmp_path):
    folder, out = tmp_path / "raw/train/REAL", str(tmp_path / "features")
    folder.mkdir(parents=True)
    for name, size in (("small", 5), ("large", 9), ("none", 0)):
        (folder / f"{name}.jpg").write_bytes(b"x" * size)
    key = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(key, "5")
    try:
        done = run_extraction(spark, str(tmp_path / "raw"), out, byte_histogram())
        errors = {r["path"].rsplit("/", 1)[1]: r["error"] for r in quarantined(done).collect()}
    finally:
        spark.conf.unset(key)
    assert errors == {"large.jpg": "ValueError: 9 bytes are more than 5", "none.jpg": "ValueError: no content"}
    assert sums(done.where("error IS NULL")) == {"small.jpg": 5} and set(done.columns) == set(FEATURES.fieldNames())


def test_changes_need_no_contents_and_no_collect(spark):
    rows = "path string, length long, modificationTime timestamp"
    now = spark.sql("SELECT timestamp '2024-01-01' AS t").first()["t"]
    list_ = spark.createDataFrame([("same", 1, now), ("new", 1, now), ("longer", 2, now), ("unlogged", 1, now), ("lost row", 1, now)], rows)
    known = spark.createDataFrame([("same", 1, now), ("longer", 1, now), ("gone", 1, now), ("lost row", 1, now)], rows)
    stored = spark.createDataFrame([("same",), ("longer",), ("gone",), ("unlogged",)], "path string")
    found = {r["path"]: r["status"] for r in file_changes(list_, known, stored).collect()}
    assert found == {"same": "unchanged", "new": "new", "longer": "changed", "unlogged": "changed", "gone": "deleted", "lost row": "new"}
    assert file_changes(list_.limit(0), known.limit(0), stored.limit(0)).count() == 0


# ---- byte ranges -------------------------------------------------------------------
def test_ranges_of_a_large_file_equal_the_whole(spark, tmp_path):
    sizes = {"none": 0, "one": 1, "edge": 1 << 20, "large": (5 << 20) + 17}
    for name, size in sizes.items():
        (tmp_path / f"{name}.jpg").write_bytes(bytes((i * i + i // 7) % 256 for i in range(min(size, 4099))) * (size // 4099 + 1) if size > 4099 else b"q" * size)
    found = listing.list_files(spark, str(tmp_path), "*.jpg")
    assert ranges.byte_ranges(found).groupBy("path").count().agg(F.max("count")).first()[0] == 6
    by_range = {r["path"]: (r["features"], r["error"]) for r in ranges.histograms_by_range(found).collect()}
    scan = with_features(files.scan_files(spark, str(tmp_path)).select("path", "content"), byte_histogram())
    whole = {r["path"]: (r["features"], r["error"]) for r in scan.collect()}
    empty = {p: x for p, x in by_range.items() if p.endswith("none.jpg")}
    assert len(by_range) == 4 and by_range == whole | empty and next(iter(empty.values())) == (None, "ValueError: no content")


def test_file_that_changes_while_ranges_are_read_is_an_error(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(b"x" * 50)
    found = listing.list_files(spark, str(tmp_path)).withColumn("length", F.lit(95).cast("long"))
    row = ranges.histograms_by_range(found, 10).first()
    assert row["features"] is None and "shorter" in row["error"]
