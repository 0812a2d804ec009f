"""Counts, lag and pending work as tables. Each works on batch and stream frames
unless it says otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.filters import drop_control
from tidemark.operators.transactions import attribute_commits, is_data, uncommitted

COUNT_KEYS = ["connector", "schema", "table", "op"]


def events_processed(log: DataFrame, include_control: bool = False, window: str | None = None,
                     lateness: str = "10 minutes") -> DataFrame:
    """Rows read per connector, table and operation, committed or not.

    ``include_control`` also counts markers that carry a data table's name (a source
    that frames every record with its own markers yields three counts per record).
    With ``window`` the counts are per tumbling window of ``ts``.
    """
    counted = drop_control(log).where(F.col("table").isNotNull())
    if not include_control:
        counted = counted.where(is_data())
    keys: list = list(COUNT_KEYS)
    if window is not None:
        counted = counted.withWatermark("ts", lateness)
        keys.append(F.window("ts", window))
    return counted.groupBy(*keys).agg(F.count("*").alias("events"))


def replication_lag(log: DataFrame, now: Column | None = None, accuracy: int = 10_000) -> DataFrame:
    """Lag between the change and its landing in milliseconds, never below zero.

    Markers count too; rows without a time, at either end, do not. Percentiles come from a sketch of
    fixed size, so one busy connector needs no more memory than any other.
    """
    landed = now if now is not None else F.col("ingested_at")
    lag_ms = F.greatest(F.unix_millis(landed) - F.unix_millis("ts"), F.lit(0))
    # greatest() skips nulls, so a row that has not landed would count as lag 0.
    timed = log.where(F.col("ts").isNotNull() & landed.isNotNull()).select("connector", lag_ms.alias("lag_ms"))
    return timed.groupBy("connector").agg(
        F.count("lag_ms").alias("events"),
        F.sum("lag_ms").alias("total_ms"),
        F.max("lag_ms").alias("max_ms"),
        F.percentile_approx("lag_ms", 0.5, accuracy).alias("p50_ms"),
        F.percentile_approx("lag_ms", 0.99, accuracy).alias("p99_ms"),
    )


def buffer_size(log: DataFrame) -> DataFrame:
    """Rows waiting for a commit, per connector; zero where all are committed. Batch only."""
    waiting = attribute_commits(log).withColumn("waiting", F.col("commit_ord").isNull().cast("bigint"))
    return waiting.groupBy("connector").agg(F.sum("waiting").alias("buffered"))


def buffer_timeline(log: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """Rows waiting at the end of each time bucket, per connector. Batch only.

    Every row adds one at its own time and takes one away at its commit; the running sum
    goes over the buckets, not over the rows.
    """
    rows = attribute_commits(log)
    steps = rows.select(
        "connector",
        F.explode(
            F.array(
                F.struct(F.col("ts").alias("at"), F.lit(1).alias("step")),
                F.struct(F.col("commit_ts").alias("at"), F.lit(-1).alias("step")),
            )
        ).alias("s"),
    ).where(F.col("s.at").isNotNull())
    per_bucket = steps.groupBy("connector", F.window("s.at", bucket).alias("w")).agg(F.sum("s.step").alias("step"))
    running = Window.partitionBy("connector").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return per_bucket.select("connector", F.col("w.start").alias("bucket"), "step").select(
        "connector", "bucket", F.sum("step").over(running).alias("buffered")
    )


def connector_status(connectors: DataFrame, log: DataFrame, now: Column, max_silence: str) -> DataFrame:
    """1 for connectors that landed something within ``max_silence`` before ``now``, else
    0; connectors without any row are 0. Batch only."""
    last_seen = log.groupBy("connector").agg(F.max("ingested_at").alias("last_seen"))
    known = connectors.select(F.col("name").alias("connector"), F.col("type").alias("connector_type"))
    fresh = F.col("last_seen") >= now - F.expr(f"INTERVAL {max_silence}")
    return known.join(last_seen, "connector", "left").select(
        "connector",
        "connector_type",
        "last_seen",
        F.coalesce(fresh.cast("int"), F.lit(0)).alias("status"),
    )


def snapshot_counts(log: DataFrame) -> DataFrame:
    """Rows read per snapshotted table."""
    return log.where(F.col("op") == "READ").groupBy("connector", "schema", "table").agg(F.count("*").alias("n_rows"))


def windowed_activity(log: DataFrame, window: str = "1 hour", lateness: str | None = None) -> DataFrame:
    """Data rows per table and tumbling window; rows later than ``lateness`` behind the
    newest are dropped on a stream."""
    rows = drop_control(log).where(is_data())
    if lateness is not None:
        rows = rows.withWatermark("ts", lateness)
    counts = rows.groupBy("connector", "schema", "table", F.window("ts", window).alias("w")).agg(
        F.count("*").alias("events")
    )
    return counts.select(
        "connector", "schema", "table", F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"), "events",
    )
