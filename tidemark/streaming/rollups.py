"""Measures of a stream as parts that add up: one per batch, merged on read.

A batch knows its own rows only, so no state is kept, no watermark is needed and no row is too
late: it counts in the window of its own time whenever it comes. A retry overwrites the parts of
its batch. A part has a row per group that the batch touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.filters import drop_control
from tidemark.operators.metrics import COUNT_KEYS
from tidemark.operators.transactions import is_data

LAG_K = 2000  # size of a sketch: its ranks are off by less than one in 500


def _window(column: str, width: str) -> Column:
    return F.window(column, width)["start"].alias("window_start")


def lag_parts(log: DataFrame, window: str = "1 hour", now: Column | None = None, k: int = LAG_K) -> DataFrame:
    """Per connector and window of the change's time: ``events``, ``total_ms``, ``max_ms`` and
    ``lags``, a mergeable sketch of the lag in milliseconds, never below zero. Rows without a
    time at either end do not count."""
    landed = now if now is not None else F.col("ingested_at")
    lag_ms = F.greatest(F.unix_millis(landed) - F.unix_millis("ts"), F.lit(0))
    timed = log.where(F.col("ts").isNotNull() & landed.isNotNull())
    return timed.groupBy("connector", _window("ts", window)).agg(
        F.count(lag_ms).alias("events"),
        F.sum(lag_ms).alias("total_ms"),
        F.max(lag_ms).alias("max_ms"),
        F.kll_sketch_agg_bigint(lag_ms, F.lit(k)).alias("lags"),
    )


def merge_lags(parts: DataFrame, by: list[str | Column], k: int = LAG_K) -> DataFrame:
    """Parts of any batches and windows → their sums per ``by``, with ``lags`` merged, which can
    be merged again."""
    return parts.groupBy(*by).agg(
        F.sum("events").alias("events"),
        F.sum("total_ms").alias("total_ms"),
        F.max("max_ms").alias("max_ms"),
        F.kll_merge_agg_bigint("lags", F.lit(k)).alias("lags"),
    )


def lag_quantile(fraction: float, lags: str = "lags") -> Column:
    return F.kll_sketch_get_quantile_bigint(lags, F.lit(fraction))


def count_parts(log: DataFrame, window: str = "1 hour", include_control: bool = False) -> DataFrame:
    """Rows per connector, table, operation and window of the change's time, as
    ``events_processed`` counts them. Rows without a time are in the window null."""
    counted = drop_control(log).where(F.col("table").isNotNull())
    if not include_control:
        counted = counted.where(is_data())
    # A window would drop rows without a time, so it is taken of those that have one only.
    timed = counted.where(F.col("ts").isNotNull()).groupBy(*COUNT_KEYS, _window("ts", window)).agg(F.count("*").alias("events"))
    untimed = counted.where(F.col("ts").isNull()).groupBy(*COUNT_KEYS).agg(F.count("*").alias("events"))
    return timed.unionByName(untimed.withColumn("window_start", F.lit(None).cast("timestamp")))


def merge_counts(parts: DataFrame, by: list[str | Column]) -> DataFrame:
    return parts.groupBy(*by).agg(F.sum("events").alias("events"))


def write_parts(stream: DataFrame, parts: dict[str, Callable[[DataFrame], DataFrame]], path: str, checkpoint: str) -> StreamingQuery:
    """Write the parts of each batch, by name, under ``path``; stop when nothing is left."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        for name, of in parts.items():
            of(batch).write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        batch.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_parts(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All parts written so far; needs at least one batch."""
    return spark.read.parquet(f"{path}/{name}").drop("batch")
