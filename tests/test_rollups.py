"""Parts of batches add up to what the whole log gives."""

import bisect
import random

from pyspark.sql import functions as F

from tidemark.schema import LOG_SCHEMA
from tidemark.sources.logs import stream_change_log
from tidemark.streaming import rollups


def log_of(spark, rows):
    """Rows (connector, ts second, landed second) as a change log."""
    frame = spark.createDataFrame(rows, "connector STRING, t LONG, l LONG")
    known = {
        "connector": F.col("connector"), "schema": F.lit("s"), "table": F.lit("t"), "op": F.lit("INSERT"),
        "ts": F.timestamp_seconds("t"), "ingested_at": F.timestamp_seconds("l"),
    }
    empty = spark.createDataFrame([], LOG_SCHEMA).schema
    return frame.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in empty.fields])


def test_merged_sketches_bound_the_rank(spark):
    rng = random.Random(5)
    rows = [("a", n % 86400, n % 86400 + int(rng.lognormvariate(4, 2))) for n in range(60000)]
    parts = None
    for i in range(6):
        part = rollups.lag_parts(log_of(spark, rows[i::6]), "6 hours")
        parts = part if parts is None else parts.unionByName(part)
    fractions = (0.01, 0.5, 0.9, 0.99, 0.999)
    merged = rollups.merge_lags(parts, ["connector"])
    found = merged.select("events", "total_ms", "max_ms", *[rollups.lag_quantile(q).alias(f"q{i}") for i, q in enumerate(fractions)]).collect()[0]
    lags = sorted((landed - t) * 1000 for _, t, landed in rows)
    assert (found["events"], found["total_ms"], found["max_ms"]) == (len(lags), sum(lags), lags[-1])
    for i, q in enumerate(fractions):
        low, high = bisect.bisect_left(lags, found[f"q{i}"]), bisect.bisect_right(lags, found[f"q{i}"])
        assert low / len(lags) - 0.004 <= q <= high / len(lags) + 0.004


def test_rows_without_times_and_empty_logs(spark):
    log = log_of(spark, [("a", 5, 7), ("a", None, 7), ("a", 9, None), ("b", 3700, 3600)])
    found = rollups.lag_parts(log).select("connector", "events", "total_ms").collect()
    assert sorted(tuple(r) for r in found) == [("a", 1, 2000), ("b", 1, 0)]
    counts = rollups.count_parts(log).select("connector", F.unix_seconds("window_start").alias("w"), "events").collect()
    assert sorted(map(tuple, counts), key=str) == [("a", 0, 2), ("a", None, 1), ("b", 3600, 1)]
    assert rollups.lag_parts(log.limit(0)).count() == rollups.count_parts(log.limit(0)).count() == 0


def test_a_row_of_long_ago_counts_and_a_retry_changes_nothing(spark, tmp_path):
    parts = {"lags": rollups.lag_parts, "counts": rollups.count_parts}

    def run():
        stream = stream_change_log(spark, f"{tmp_path}/landed", "log", max_files=1)
        rollups.write_parts(stream, parts, f"{tmp_path}/parts", f"{tmp_path}/checkpoint").awaitTermination()
        read = rollups.read_parts(spark, f"{tmp_path}/parts", "counts")
        found = rollups.merge_counts(read, ["connector", F.unix_seconds("window_start").alias("w")]).collect()
        return sorted(map(tuple, found))

    log_of(spark, [("a", 100_000_000, 100_000_001)]).coalesce(1).write.parquet(f"{tmp_path}/landed", mode="append")
    assert run() == [("a", 100_000_000 // 3600 * 3600, 1)]
    log_of(spark, [("a", 50, 100_000_002), ("a", 100_000_000, 100_000_003)]).coalesce(1).write.parquet(f"{tmp_path}/landed", mode="append")
    expected = [("a", 0, 1), ("a", 100_000_000 // 3600 * 3600, 2)]
    assert run() == expected
    # The second batch as after a loss of its commit.
    (tmp_path / "checkpoint" / "commits" / "1").unlink()
    (tmp_path / "checkpoint" / "commits" / ".1.crc").unlink(missing_ok=True)
    assert run() == expected
