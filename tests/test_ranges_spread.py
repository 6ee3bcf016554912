from pixelproof.plans.ranges import histograms_by_range


def test_reads_are_not_merged_into_one_task(spark, tmp_path):
    """Paths are little data to shuffle, what they stand for is not."""
    paths = []
    for i in range(200):
        path = tmp_path / f"{i}.bin"
        path.write_bytes(b"x" * 10)
        paths.append((f"file:{path}", 10))
    found = histograms_by_range(spark.createDataFrame(paths, "path string, length long"))
    found.write.format("noop").mode("overwrite").save()
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()
    assert {tuple(r["features"][119:122]) for r in found.collect()} == {(0.0, 10.0, 0.0)}
