import os

import pytest

from pixelproof.workloads import relations as rel


def files_below(root):
    return sorted((os.path.relpath(folder, root), name.rsplit(".", 1)[1], open(f"{folder}/{name}", "rb").read()) for folder, _, names in os.walk(root) for name in names)


@pytest.fixture
def pages(spark, tmp_path):
    rows = [(6, "a", "<p>é</p>"), (1, "b", None), (1, "b", None), (12, "c", ""), (None, "d", "x\ny")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    return str(tmp_path)


def test_each_row_is_a_file_and_nothing_else_is_left(spark, pages):
    real, fake = "split=test/label_name=REAL", "split=train/label_name=FAKE"
    unknown = "split=train/label_name=__HIVE_DEFAULT_PARTITION__"
    expected = [(real, "txt", "<p>é</p>\n".encode()), (real, "txt", b"\n"), (fake, "txt", b"\n"), (fake, "txt", b"\n"), (unknown, "txt", b"x\ny\n")]
    root = rel.land_pages(spark, pages)
    assert files_below(root) == sorted(expected)
    rel.replace_folder(spark, pages, root, "append")
    assert files_below(root) == sorted(expected + 2 * [(fake, "txt", b"\n")])
    rel.replace_folder(spark, pages, root, "overwrite")
    assert files_below(root) == sorted(expected)


def test_endings_hold_lines_as_csv_and_text_have_them(spark, pages):
    digits = ["<p>é</p>".encode().hex().upper().encode(), b"", b"x\ny".hex().upper().encode()]
    expected = [("png", "png", digits[0] + b"\n"), ("png", "png", b'""\n'), ("jPg", "jPg", b""), ("jPg", "jPg", b""), ("jPg", "jPg", digits[2] + b"\n")]
    expected += [("txt", "txt", d + b"\n") for d in (*digits, b"", b"")]
    assert files_below(rel.land_endings(spark, pages)) == sorted(expected)
