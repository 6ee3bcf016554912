import numpy as np
from fixtures import png, png_tree

from pixelproof.sources import files, tables


def tree(tmp_path):
    png_tree(tmp_path)
    return str(tmp_path / "raw")


def test_inventory_by_split_and_label(spark, tmp_path):
    root = tree(tmp_path)
    found = files.file_inventory(files.with_split_and_label(files.scan_files(spark, root)))
    rows = {(r["split"], r["label_name"]): r["n_files"] for r in found.collect()}
    assert rows == {(s, c): 3 for s in ("train", "test") for c in ("REAL", "FAKE")}


def test_inventory_does_not_read_contents(spark, tmp_path):
    found = files.file_inventory(files.with_split_and_label(files.scan_files(spark, tree(tmp_path))))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan


def test_all_spellings_in_one_scan(spark, tmp_path):
    for name in ("a.jpg", "b.jpeg", "c.png", "d.JPG", "e.txt", "f.PNG", "g.JPEG", "h.Jpg", "i.jPEG"):
        (tmp_path / name).write_bytes(b"x")
    names = {r["path"].rsplit("/", 1)[1] for r in files.scan_files(spark, str(tmp_path)).select("path").collect()}
    assert names == {"a.jpg", "b.jpeg", "c.png", "d.JPG", "f.PNG", "g.JPEG", "h.Jpg", "i.jPEG"}
    skipped = files.ending_inventory(spark, str(tmp_path)).where("not is_image").collect()
    assert [(r["ending"], r["n_files"]) for r in skipped] == [("txt", 1)]


def test_empty_files_are_counted(spark, tmp_path):
    root = tree(tmp_path)
    for name in ("train/REAL/a b+c%20[1].png", "test/FAKE/no.JPG", "outside.png"):
        (tmp_path / "raw" / name).write_bytes(b"")
    assert files.scan_files(spark, root).count() == 12
    empty = {r["path"].rsplit("/raw/", 1)[1] for r in files.empty_files(spark, root).collect()}
    assert empty == {"train/REAL/a b+c%20[1].png", "test/FAKE/no.JPG", "outside.png"}
    rows = files.file_inventory(files.with_split_and_label(files.all_files(spark, root))).collect()
    counts = {(r["split"], r["label_name"]): (r["n_files"], r["n_empty"]) for r in rows}
    assert counts[("train", "REAL")] == (4, 1) and counts[("test", "FAKE")] == (4, 1) and counts[(None, None)] == (1, 1)
    assert files.empty_files(spark, root, "*.none").count() == 0


def test_recursion_can_be_turned_off(spark, tmp_path):
    (tmp_path / "top.jpg").write_bytes(b"x")
    assert files.scan_files(spark, str(tmp_path), recursive=False).count() == 1


def test_split_and_label_from_either_layout(spark):
    paths = ["f:/raw/train/REAL/1.jpg", "f:/raw/split=test/label_name=FAKE/1.jpg", "f:/raw/other/1.jpg"]
    found = files.with_split_and_label(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert [(r["split"], r["label_name"], r["label"]) for r in found] == [
        ("train", "REAL", 0),
        ("test", "FAKE", 1),
        (None, None, None),
    ]
    archived = spark.createDataFrame([("f:/arch/train/FAKE/old/test/REAL/x.jpg",)], "path string")
    assert files.with_split_and_label(archived).first()["split"] == "test"  # the folders nearest to the file


def test_every_scan_spells_a_path_alike(spark, tmp_path):
    names = ["plain.png", "a b.png", "c%20d.png", "e+f.png", "[1].png", "\u00e9{2}.png"]
    for name in names:
        (tmp_path / name).write_bytes(png(np.zeros((2, 2, 3))))
    paths = {r["path"] for r in files.scan_files(spark, str(tmp_path)).select("path").collect()}
    assert {p.rsplit("/", 1)[1] for p in paths} == set(names)
    assert {r["path"] for r in files.scan_images(spark, str(tmp_path)).select("path").collect()} == paths
    again = files.scan_files(spark, [files.as_literal_glob(p) for p in paths])
    assert {r["path"] for r in again.select("path").collect()} == paths


def test_broken_picture_stays_in_the_scan(spark, tmp_path):
    (tmp_path / "good.png").write_bytes(png(np.zeros((4, 4, 3))))
    (tmp_path / "bad.png").write_bytes(b"no picture")
    rows = files.scan_images(spark, str(tmp_path)).collect()
    found = {r["path"].rsplit("/", 1)[1]: r["image"]["height"] for r in rows}
    assert found == {"good.png": 4, "bad.png": -1}


def test_csv_keeps_awkward_text(spark, tmp_path):
    rows = [('a "b", c', "REAL", 1.5), (" leading", "FAKE", None)]
    schema = "path string, result string, confidence double"
    df = spark.createDataFrame(rows, schema)
    tables.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_overwrite_replaces_only_written_partitions(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "train"), (2, "test")], "v int, split string")
    tables.write_table(df, out, partition_by=("split",))
    tables.write_table(df.where("split = 'test'").selectExpr("v + 10 AS v", "split"), out, partition_by=("split",))
    assert sorted(r["v"] for r in tables.read_table(spark, out).collect()) == [1, 12]
    tables.write_table(df.where("split = 'train'"), out, partition_by=("split",), whole_table=True)
    assert [r["v"] for r in tables.read_table(spark, out).collect()] == [1]
