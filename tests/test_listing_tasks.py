from pixelproof.sources.files import LISTING_TASKS, USUAL, scan_files
from pixelproof.streaming.arrivals import file_stream


def test_loads_of_names_do_not_list_each_in_a_task(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(b"a")
    own = spark.conf.get(LISTING_TASKS)
    few = str(4 * spark.sparkContext.defaultParallelism)
    try:
        for load in (scan_files, file_stream):
            spark.conf.set(LISTING_TASKS, USUAL)
            load(spark, str(tmp_path))
            assert spark.conf.get(LISTING_TASKS) == few
        spark.conf.set(LISTING_TASKS, "5")
        scan_files(spark, str(tmp_path))
        assert spark.conf.get(LISTING_TASKS) == "5"
    finally:
        spark.conf.set(LISTING_TASKS, own)
