import pytest
from fixtures import png_tree

from pixelproof.__main__ import main


@pytest.mark.parametrize("featurizer", ["pixel_histogram", "byte_histogram"])
def test_jobs_one_after_another(spark, tmp_path, featurizer):
    png_tree(tmp_path, per_folder=6, size=8)
    root, out = str(tmp_path / "raw"), str(tmp_path / "out")
    common = ["--out", out, "--featurizer", featurizer]

    def job(name, *more):
        return main([name, *common, *more], spark).collect()

    extract = "extract" if featurizer == "pixel_histogram" else "stream-extract"
    assert sum(r["n_usable"] for r in job(extract, "--root", root)) == 24
    assert len(job("train")) == 2
    assert job("check")[0]["passed"] is True  # six of seven: no report yet
    assert job("report", "--dataset", "pictures")[0]["n_filled"] == 7
    assert len(job("sample", "--root", root)) == 12
    model = f"{out}/results/models/LogisticRegression"
    new = ["--root", root, "--model", model]
    name = "score" if featurizer == "pixel_histogram" else "stream-score"
    assert sum(r["n"] for r in main([name, "--out", f"{out}/new", "--featurizer", featurizer, *new], spark).collect()) == 24


def test_missing_arguments(spark, capsys):
    with pytest.raises(SystemExit):
        main(["score", "--out", "x", "--root", "y"], spark)
    with pytest.raises(SystemExit):
        main(["run", "--out", "x"], spark)
    assert "needs --root" in capsys.readouterr().err
