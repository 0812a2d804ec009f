"""Raw logs as streams: every micro-batch is normalised by the batch operators.

A message means something only with its neighbours: the table definition before it, the
commit after it. So each batch is put together with the raw rows that the batches before
it left *pending*: those after the last commit, and the latest table definitions. Pending
rows are a small written table per batch. A repeated batch reads the pending rows of the
batch before and overwrites its own outputs, so nothing is lost or doubled, and unlike the
stream-stream join there is no limit on how long a transaction may stay open. Batches must
follow the order of the log, as landed files and topic partitions do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.pgbytes import char, uint
from tidemark.operators.filters import FINGERPRINT, dedup_fingerprint, owner_filter
from tidemark.operators.joins import side_join
from tidemark.operators.mysql import is_commit
from tidemark.operators.oracle import redo_events
from tidemark.operators.postgres import RELATION
from tidemark.operators.transactions import attribute_commits, is_data, uncommitted
from tidemark.plans.normalise import normalise, publishable
from tidemark.streaming.sinks import write_lake


def _is_pg(kind: str) -> Column:
    return char(F.col("payload"), 1) == kind


def _open_tail(raw: DataFrame, commit: Column, definition: Column, definition_id: Column) -> DataFrame:
    """Rows after the last commit of their connector, and the latest definition of each id."""
    last = raw.where(commit).groupBy("connector").agg(F.max("ord").alias("__last"))
    # A row per connector, so the rows need no shuffle.
    tail = side_join(raw, F.broadcast(last), ["connector"], "left").where(
        F.col("__last").isNull() | (F.col("ord") > F.col("__last"))
    )
    newest = (
        raw.where(definition)
        .groupBy("connector", definition_id.alias("__id"))
        .agg(F.max_by(F.struct(*raw.columns), "ord").alias("row"))
        .select("row.*")
    )
    return tail.select(*raw.columns).unionByName(newest).dropDuplicates(["connector", "ord"])


def pending_rows(kind: str, raw: DataFrame) -> DataFrame:
    """Raw rows that later rows still need."""
    if kind == "postgres":
        return _open_tail(raw, _is_pg("C"), _is_pg(RELATION), uint(F.col("payload"), 2, 4))
    if kind == "mysql":
        return _open_tail(raw, is_commit(), F.col("event") == "TABLE_MAP", F.col("table_id"))
    if kind == "log":
        return uncommitted(raw)
    raise ValueError(f"unknown kind {kind!r}")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _commit(kind: str) -> Column:
    return _is_pg("C") if kind == "postgres" else is_commit()


def _last_commits(raw: DataFrame, commit: Column, earlier: DataFrame | None) -> DataFrame:
    """Position of the last commit seen, by connector."""
    last = raw.where(commit).select("connector", F.col("ord").alias("last_commit"))
    every = last if earlier is None else last.unionByName(earlier)
    return every.groupBy("connector").agg(F.max("last_commit").alias("last_commit"))


def _in_time(batch: DataFrame, last: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Split into rows after the last commit of the batches before, and late ones."""
    if last is None:
        return batch, batch.limit(0)
    placed = side_join(batch, last, ["connector"], "left")
    late = F.coalesce(F.col("ord") <= F.col("last_commit"), F.lit(False))
    return placed.where(~late).select(*batch.columns), placed.where(late).select(*batch.columns)


def _with_earlier_commits(rows: DataFrame, counts: DataFrame | None) -> DataFrame:
    """Transaction numbers count all commits of the log, not those of this batch."""
    if counts is None:
        return rows
    placed = side_join(rows, counts.select("connector", "commits"), ["connector"], "left")
    number = F.col("tx").cast("bigint") + F.coalesce("commits", F.lit(0))
    return placed.withColumn("tx", number.cast("string")).drop("commits")


def publish_raw(stream: DataFrame, kind: str, path: str, checkpoint: str, **settings) -> StreamingQuery:
    """Stream of landed rows of a kind (postgres, mysql, or log for decoded rows) → under
    ``path``, each with a folder ``batch=<id>``: ``events`` by topic, ``pending``, and for
    raw logs ``dead_letters``, ``abandoned`` (rows whose transaction no commit closed before
    a later commit of the connector) and ``late`` (raw rows at or before a commit of an
    earlier batch, whose place in the log has been dealt with). Every data row is in exactly
    one of events, dead letters, abandoned, late and the last pending. Stops when nothing is
    left to read."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, here = f"batch={batch_id - 1}", f"batch={batch_id}"
        pending = _read(spark, f"{path}/pending/{before}")
        if kind != "log":
            batch, late = _in_time(batch, _read(spark, f"{path}/positions/{before}"))
            late.write.mode("overwrite").parquet(f"{path}/late/{here}")
        raw = batch if pending is None else batch.unionByName(pending)
        raw.persist()
        pending_rows(kind, raw).write.mode("overwrite").parquet(f"{path}/pending/{here}")
        rows = raw
        if kind == "log":
            committed = attribute_commits(raw).where(F.col("commit_ord").isNotNull())
        else:
            rows = normalise(kind, raw, **settings)
            if kind == "mysql":
                counts = _read(spark, f"{path}/commits/{before}")
                rows = _with_earlier_commits(rows, counts)
                seen = raw.groupBy("connector").agg(F.count_if(is_commit()).alias("commits"))
                total = seen if counts is None else seen.unionByName(counts)
                total.groupBy("connector").agg(F.sum("commits").alias("commits")).write.mode("overwrite").parquet(
                    f"{path}/commits/{here}"
                )
            rows = rows.where(is_data() | F.col("reason").isNotNull()).persist()
            committed, waiting, dead = publishable(rows)
            # A row that is still pending is reported once, when its transaction is closed
            # or a commit of the connector shows that it never will be.
            keep = spark.read.schema(raw.schema).parquet(f"{path}/pending/{here}").select("connector", "ord")
            for name, settled in (("dead_letters", dead), ("abandoned", waiting)):
                settled.join(keep, ["connector", "ord"], "left_anti").write.mode("overwrite").parquet(f"{path}/{name}/{here}")
            _last_commits(raw, _commit(kind), _read(spark, f"{path}/positions/{before}")).write.mode("overwrite").parquet(
                f"{path}/positions/{here}"
            )
        write_lake(committed, f"{path}/events/{here}", mode="overwrite")
        rows.unpersist()
        raw.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _first_seen(redo: DataFrame, seen: DataFrame | None) -> DataFrame:
    """One row per statement at a position, without those that earlier batches had."""
    once = dedup_fingerprint(redo, order="ord")
    if seen is None:
        return once
    same = reduce(Column.__and__, [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in FINGERPRINT])
    return once.alias("r").join(seen.alias("s"), same, "left_anti")


def publish_redo(stream: DataFrame, path: str, checkpoint: str, owner: str, start: int = 0, container: str | None = None,
                 literal_parity: bool = False) -> StreamingQuery:
    """Stream of mined redo records → under ``path``, each with a folder ``batch=<id>``:
    ``events`` by topic, ``dead_letters`` and ``late``. Stops when nothing is left to read.

    Mining goes on from the last position read, which is read again, so the statements at that
    position come twice. They are recognised by their fingerprints, which are carried from
    batch to batch for the last position of each connector only: the state ends when the
    position moves on, not with a clock. Records below that position, repeats or not, go to
    ``late``. Every record of the owner is published, dead, late, or a repeat of one that is.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, here = f"batch={batch_id - 1}", f"batch={batch_id}"
        mine = owner_filter(batch, owner, start, container)
        mine.persist()
        seen = _read(spark, f"{path}/seen/{before}")
        last = None if seen is None else seen.groupBy("connector").agg(F.max("scn").alias("last_scn"))
        rows, late = mine, mine.limit(0)
        if last is not None:
            placed = side_join(mine, last, ["connector"], "left")
            below = F.coalesce(F.col("scn") < F.col("last_scn"), F.lit(False))
            rows, late = placed.where(~below).select(*mine.columns), placed.where(below).select(*mine.columns)
        fresh = _first_seen(rows, seen)
        fresh.persist()
        parsed = redo_events(fresh, container, literal_parity).withColumnRenamed("sql_redo", "raw").persist()
        published, _, dead = publishable(parsed)
        write_lake(published, f"{path}/events/{here}", mode="overwrite")
        dead.write.mode("overwrite").parquet(f"{path}/dead_letters/{here}")
        late.write.mode("overwrite").parquet(f"{path}/late/{here}")
        prints = fresh.select(*FINGERPRINT)
        prints = prints if seen is None else prints.unionByName(seen)
        newest = prints.groupBy("connector").agg(F.max("scn").alias("__newest"))
        side_join(prints, F.broadcast(newest), ["connector"], "inner").where(F.col("scn") == F.col("__newest")).select(*FINGERPRINT).write.mode(
            "overwrite").parquet(f"{path}/seen/{here}")
        parsed.unpersist()
        fresh.unpersist()
        mine.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
