"""Restarts that read only the landed files they must."""

from pyspark.sql import functions as F

from tidemark.operators.positions import resume
from tidemark.sources import manifest
from tidemark.sources.logs import read_change_log

from test_transactions import log_frame


def test_files_before_the_position_are_not_read(spark, tmp_path):
    rows = [("ab"[i % 2], "t", "INSERT", i) for i in range(400)]
    log = log_frame(spark, rows).withColumn("offset", F.when((F.col("ord") == 3) & (F.col("connector") == "b"), "?").otherwise(F.col("offset")))
    path = str(tmp_path)
    for lo in range(0, 400, 100):
        for connector in "ab":
            log.where((F.col("connector") == connector) & (F.col("ord") >= lo) & (F.col("ord") < lo + 100)).coalesce(1).write.mode("append").parquet(path)
    landed = read_change_log(spark, path, "log")
    listed = manifest.file_positions(landed)
    assert listed.count() == 8
    stored = spark.createDataFrame([("a", "250"), ("a", "40"), ("b", "399")], "connector string, offset string")
    for inclusive, files in ((True, 4), (False, 3)):  # 2 of a, the last of b if inclusive, and the unreadable one
        assert manifest.files_to_read(listed, stored, inclusive).count() == files
        got = manifest.resume_files(spark, path, listed, stored, inclusive)
        assert len(got.inputFiles()) == files
        want = resume(landed, stored, inclusive)
        assert sorted(map(tuple, got.select("connector", "ord").collect())) == sorted(map(tuple, want.select("connector", "ord").collect()))
    # A connector without a position is read whole; nothing stored, everything read.
    none = spark.createDataFrame([("a", " ")], "connector string, offset string")
    assert manifest.resume_files(spark, path, listed, none).count() == 400
    assert manifest.resume_files(spark, path, listed.limit(0), stored).count() == 0
