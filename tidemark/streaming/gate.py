"""The commit gate on an unbounded log.

Each micro-batch adds the rows it leaves open and the commits it brought to tables of its
own; nothing that waits is written again, except that now and then the two are put together
into a base without the rows settled by then. A row waits as long as its transaction is
open, whatever the time, and no clock or watermark decides about it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ordered import Carry, carry
from tidemark.operators.transactions import ROW_ORDER, TX, is_data
from tidemark.schema import LOG_SCHEMA

# Batches between two bases, and batches for which commits are remembered.
COMPACT_EVERY = 16
REMEMBER = 256

COMMIT_SCHEMA = "connector STRING, tx STRING, ord BIGINT, ordinal INT, ts TIMESTAMP, offset STRING, landed BIGINT"
HORIZON_SCHEMA = "connector STRING, horizon BIGINT"


def _same(keys: list[str], a: str, b: str) -> Column:
    return reduce(Column.__and__, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])


def _of_transactions(rows: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of the transactions listed; missing ids count as one id."""
    return rows.alias("r").join(touched.alias("t"), _same(TX, "r", "t"), "left_semi")


class _State:
    """What the batches before one left under ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema, batch: int, every: int) -> None:
        self.spark, self.path = spark, path
        self.base = batch // every * every - 1
        self.deltas = range(self.base + 1, batch)
        self.open = self._read("open", schema)
        self.commits = self._read("commits", COMMIT_SCHEMA)
        self.horizon = self._paths(HORIZON_SCHEMA, [f"{path}/horizon_base/batch={self.base}"] if self.base >= 0 else [])

    def _paths(self, schema, paths: list[str]) -> DataFrame:
        if not paths:
            # The planner knows that nothing is in it, so joins with it shuffle nothing.
            return self.spark.createDataFrame([], schema).limit(0)
        return self.spark.read.schema(schema).parquet(*paths)

    def _read(self, name: str, schema) -> DataFrame:
        base = [f"{self.path}/{name}_base/batch={self.base}"] if self.base >= 0 else []
        return self._paths(schema, base + [f"{self.path}/{name}/batch={b}" for b in self.deltas])


def _settled(rows: DataFrame, commits: DataFrame) -> DataFrame:
    """Rows and commits together, with the next commit of any kind (``commit``) and the next
    one that was there before (``known``); ``fresh`` tells what this batch brought."""
    is_commit = F.col("op") == "COMMIT"
    together = rows.unionByName(commits.drop("landed").withColumn("op", F.lit("COMMIT")), allowMissingColumns=True)
    commit = F.when(is_commit, F.struct("ord", "ts", "offset"))
    return carry(
        together, TX, ROW_ORDER,
        [Carry("commit", commit, ahead=True), Carry("known", F.when(is_commit & ~F.col("fresh"), F.col("ord")), ahead=True)],
    ).where(is_data())


def _still_open(rows: DataFrame, commits: DataFrame) -> DataFrame:
    found = _settled(rows.withColumn("fresh", F.lit(False)), commits.withColumn("fresh", F.lit(False)))
    return found.where(F.col("commit").isNull()).select(*rows.columns)


def _gate(batch: DataFrame, batch_id: int, path: str, every: int, remember: int) -> None:
    spark = batch.sparkSession
    state = _State(spark, path, batch.schema, batch_id, every)
    batch.persist()

    def write(rows: DataFrame, name: str) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")

    commits = batch.where(F.col("op") == "COMMIT").select(
        *TX, "ord", "ordinal", "ts", "offset", F.lit(batch_id).cast("bigint").alias("landed"))
    rows = batch.where(is_data())
    placed = rows.alias("r").join(state.horizon.alias("h"), _same(["connector"], "r", "h"), "left")
    too_late = F.coalesce(F.col("r.ord") <= F.col("horizon"), F.lit(False))
    rows, late = placed.where(~too_late).select("r.*"), placed.where(too_late).select("r.*")

    closing = commits.select(*TX).distinct()
    waiting = _of_transactions(state.open, closing)
    earlier = _of_transactions(state.commits, closing.union(rows.select(*TX)).distinct())
    fresh, old = F.lit(True), F.lit(False)
    found = _settled(
        rows.withColumn("fresh", fresh).unionByName(waiting.withColumn("fresh", old)),
        commits.withColumn("fresh", fresh).unionByName(earlier.withColumn("fresh", old)),
    )
    # A row that waited under a commit known before was published then.
    closed = F.col("commit").isNotNull() & (F.col("fresh") | F.col("known").isNull())
    found.persist()
    write(found.where(closed).select(
        *batch.columns, F.col("commit.ord").alias("commit_ord"), F.col("commit.ts").alias("commit_ts"),
        F.col("commit.offset").alias("commit_offset")), "committed")
    write(found.where(F.col("fresh") & F.col("commit").isNull()).select(*batch.columns), "open")
    write(commits, "commits")
    write(late, "late")
    found.unpersist()
    batch.unpersist()
    if (batch_id + 1) % every == 0:
        _compact(spark, path, batch.schema, batch_id, every, remember)
    write(spark.range(1), "batches")


def _compact(spark: SparkSession, path: str, schema, batch_id: int, every: int, remember: int) -> None:
    """Base of the state after a batch: rows still open, commits of the last batches, and how
    far the log reaches whose commits are let go."""
    before = _State(spark, path, schema, batch_id, every)

    def all_of(rows: DataFrame, name: str) -> DataFrame:
        return rows.unionByName(spark.read.schema(rows.schema).parquet(f"{path}/{name}/batch={batch_id}"))

    commits = all_of(before.commits, "commits")
    kept = F.col("landed") > batch_id - remember
    horizon = commits.where(~kept).select("connector", F.col("ord").alias("horizon")).unionByName(before.horizon)
    for rows, name in (
        (_still_open(all_of(before.open, "open"), commits), "open"),
        (commits.where(kept), "commits"),
        (horizon.groupBy("connector").agg(F.max("horizon").alias("horizon")), "horizon"),
    ):
        rows.write.mode("overwrite").parquet(f"{path}/{name}_base/batch={batch_id}")


def publish_committed(log: DataFrame, path: str, checkpoint: str, compact_every: int = COMPACT_EVERY,
                      remember: int = REMEMBER) -> StreamingQuery:
    """Stream of log rows → under ``path``, each with a folder ``batch=<id>`` that a retry
    overwrites: ``committed`` (rows with the columns of the batch gate) and ``late``. Rows that
    wait are read by ``read_waiting``. Every data row is in exactly one of the three. Stops
    when nothing is left to read.

    A row belongs to the next commit of its transaction id at or after it, so an id that
    comes back is kept apart. There is no limit on how long a transaction stays open. Rows
    and commits may come after later parts of the log: a row whose commit came before it is
    published with that commit, as long as the commit is remembered, ``remember`` batches. Beyond
    that, rows at or before the last forgotten commit of their connector go to ``late``. A
    row published under a later commit of a reused id, because its own commit was late,
    stays so.
    """
    return (
        log.writeStream.foreachBatch(lambda batch, batch_id: _gate(batch, batch_id, path, compact_every, remember))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_waiting(spark: SparkSession, path: str, schema=LOG_SCHEMA, compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Rows under ``path`` whose transaction no commit has closed; ``compact_every`` as written."""
    last = spark.read.parquet(f"{path}/batches").agg(F.max("batch")).first()[0]
    state = _State(spark, path, schema, last + 1, compact_every)
    return _still_open(state.open, state.commits)


def dedup_stream(rows: DataFrame, keys: list[str], event_time: str = "ts", within: str = "10 minutes",
                 salted: bool = True) -> DataFrame:
    """First row of each key; a copy is recognised for ``within`` after it. Used with the
    event id, or with the fingerprint keys of redo records.

    Copies of one key may be a large part of the input. ``salted`` first removes them per
    input partition, so that at most one row per partition reaches the key's own task;
    it keeps a second, short-lived entry per key.
    """
    timed = rows.withWatermark(event_time, within)
    if salted:
        spread = timed.withColumn("__salt", F.spark_partition_id())
        timed = spread.dropDuplicatesWithinWatermark([*keys, "__salt"]).drop("__salt")
    return timed.dropDuplicatesWithinWatermark(keys)
