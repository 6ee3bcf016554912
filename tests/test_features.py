import numpy as np
import pyarrow as pa
import pytest
from fixtures import png, png_tree

from pixelproof.functions import featurizers
from pixelproof.functions.features import Featurizer, FeatureWidthError, _bytes_of, _calls, featurize_batch, with_features
from pixelproof.sources.files import scan_images, with_split_and_label


def test_byte_histogram_counts_every_byte():
    out = featurize_batch(pa.array([b"aab", b"\xff", b""]), featurizers.byte_histogram()).to_pylist()
    assert out[0]["features"][ord("a")] == 2 and sum(out[0]["features"]) == 3
    assert out[1]["features"][255] == 1
    assert out[2] == {"features": None, "error": "ValueError: no content"}


def test_batches_are_cut_by_rows_and_by_bytes():
    calls = []

    def load():
        def compute(items):
            calls.append(len(items))
            return np.array([[len(i)] for i in items])

        return (lambda content: content), compute

    few = Featurizer("few-rows", 1, load, rows_per_call=3)
    out = featurize_batch(pa.array([b"x" * (i + 1) for i in range(7)]), few).to_pylist()
    assert [r["features"] for r in out] == [[i + 1] for i in range(7)]
    assert calls == [3, 3, 1]
    calls.clear()
    small = Featurizer("few-bytes", 1, load, bytes_per_call=2000)
    featurize_batch(pa.array([b"x" * 1000] * 4), small)
    assert max(calls) <= 2


def test_item_that_spoils_a_call_is_found():
    def load():
        def compute(items):
            if b"bad" in items:
                raise RuntimeError("shape")
            return np.array([[len(i)] for i in items])

        return bytes, compute

    out = featurize_batch(pa.array([b"a", b"bad", b"ccc", None]), Featurizer("spoiled", 1, load)).to_pylist()
    assert [r["features"] for r in out] == [[1.0], None, [3.0], None]
    assert [r["error"] for r in out] == [None, "RuntimeError: shape", None, "ValueError: no content"]
    only_bad = featurize_batch(pa.array([b"bad"]), Featurizer("spoiled", 1, load)).to_pylist()
    assert only_bad[0]["features"] is None


def test_empty_batch():
    assert featurize_batch(pa.array([], pa.binary()), featurizers.byte_histogram()).to_pylist() == []


def test_wrong_width_fails():
    wrong = Featurizer("wrong", 5, lambda: (bytes, lambda items: np.zeros((len(items), 4))))
    with pytest.raises(FeatureWidthError):
        featurize_batch(pa.array([b"x"]), wrong)


def test_wrong_width_fails_the_job(spark):
    def load():
        return bytes, lambda items: np.zeros((len(items), 4))

    df = spark.createDataFrame([(bytearray(b"x"),)], "content binary")
    with pytest.raises(Exception, match="FeatureWidthError"):
        with_features(df, Featurizer("wrong-in-job", 5, load)).collect()


def test_pixel_histogram_of_known_pixels(spark, tmp_path):
    pixels = np.zeros((2, 2, 3), dtype=np.uint8)
    pixels[0, 0] = (255, 10, 20)
    (tmp_path / "p.png").write_bytes(png(pixels))
    rows = with_features(scan_images(spark, str(tmp_path)), featurizers.pixel_histogram(), "image").collect()
    found = np.array(rows[0]["features"])
    assert len(found) == 780
    red, green, blue = found[:256], found[256:512], found[512:768]
    assert (red[255], red[0], green[10], blue[20]) == (1, 3, 1, 1)
    flat = pixels.reshape(-1, 3).astype(float)
    assert found[768:].reshape(4, 3) == pytest.approx(
        np.stack([flat.mean(0), flat.std(0), flat.min(0), flat.max(0)]), rel=1e-6
    )


def test_grey_and_transparent_pictures():
    decode, compute = featurizers.pixel_histogram().load()
    grey = decode({"data": bytes([7, 7]), "nChannels": 1})
    clear = decode({"data": bytes([1, 2, 3, 99]), "nChannels": 4})
    out = compute([grey, clear])
    assert out[0][7] == 2 and out[0][256 + 7] == 2 and out[0][512 + 7] == 2
    assert out[1][3] == 1 and out[1][256 + 2] == 1 and out[1][512 + 1] == 1


def test_pixels_from_files_equal_numpy(spark, tmp_path):
    pictures = png_tree(tmp_path)
    scan = with_split_and_label(scan_images(spark, str(tmp_path / "raw")))
    rows = with_features(scan, featurizers.pixel_histogram(), "image").collect()
    assert len(rows) == len(pictures)
    for row in rows:
        pixels = pictures["/".join(row["path"].split("/")[-3:])]
        expected = np.concatenate([np.bincount(pixels[:, :, c].ravel(), minlength=256) for c in range(3)])
        assert np.array_equal(np.array(row["features"][:768]), expected)


def test_broken_picture_gets_an_error(spark, tmp_path):
    (tmp_path / "bad.png").write_bytes(b"no picture")
    row = with_features(scan_images(spark, str(tmp_path)), featurizers.pixel_histogram(), "image").first()
    assert row["features"] is None and row["error"]


def test_vectors_that_are_not_finite_are_quarantined():
    bad = Featurizer("bad", 2, lambda: (lambda x: x, lambda items: np.array([[1.0, float(len(i)) if len(i) > 1 else np.nan] for i in items])))
    out = featurize_batch(pa.array([b"ab", b"c"]), bad).to_pylist()
    assert out[0]["features"] == [1.0, 2.0] and out[1]["features"] is None and "finite" in out[1]["error"]


def test_calls_hold_so_many_bytes_and_a_large_item_stands_alone():
    sizes = _bytes_of(pa.array([b"a" * 10, b"b" * 500, b"", b"c" * 30, b"d" * 30, None]))
    assert sizes.tolist() == [10, 500, 0, 30, 30, 0]
    assert list(_calls(sizes, 3, 60)) == [(0, 1), (1, 2), (2, 5), (5, 6)]


def test_a_large_item_is_counted_in_pieces():
    items = [b"ab", b"xyz" * 1_500_000, b"b"]
    out = featurize_batch(pa.array(items), featurizers.byte_histogram()).to_pylist()
    assert out[1]["features"][ord("x")] == 1_500_000 and out[0]["features"][ord("a")] == 1 and out[2]["features"][ord("b")] == 1
