"""Sinks: files, Kafka, and several outputs from one stream."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.lake import latest_change
from tidemark.operators.positions import latest_offsets
from tidemark.operators.routing import messages, route


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder in the cluster's shared checkpoint folder. Only a local session
    without that setting gets a folder of this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"{purpose}-")


def run_available(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
                  fmt: str = "parquet") -> None:
    """Process what is there and stop. The file sink writes each row once, also after a
    restart with the same checkpoint."""
    writer = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()


def write_lake(rows: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Published rows as files per topic. Rebalancing splits a topic that holds much of the
    data over many tasks and gathers small topics into few files."""
    routed = route(rows)
    routed.hint("rebalance", "topic").write.mode(mode).partitionBy("topic").format(fmt).save(path)


def kafka_options(servers: str, **extra: str) -> dict[str, str]:
    """Options of the Kafka sink: every write is confirmed by all replicas."""
    return {"kafka.bootstrap.servers": servers, "kafka.acks": "all", **extra}


def write_kafka(log: DataFrame, servers: str, key: str = "eventId", pk: Column | None = None, **extra: str) -> None:
    """Publish a batch; needs Spark's Kafka package on the class path."""
    messages(log, key, pk).write.format("kafka").options(**kafka_options(servers, **extra)).save()


def stream_kafka(log: DataFrame, servers: str, checkpoint: str, key: str = "eventId", pk: Column | None = None,
                 **extra: str) -> StreamingQuery:
    """Publish a stream; positions advance only after a batch was written."""
    writer = messages(log, key, pk).writeStream.format("kafka").options(**kafka_options(servers, **extra))
    return writer.option("checkpointLocation", checkpoint).start()


def publish_batches(committed: DataFrame, path: str, checkpoint: str, pk: list[str] | None = None,
                    dead: Column | None = None) -> StreamingQuery:
    """Write each batch of a stream of committed rows to several outputs, then stop when
    nothing is left.

    Under ``path``: ``events`` by topic, ``dead_letters`` (rows for which ``dead`` holds),
    ``latest`` (last change per ``pk``) and, only after those succeeded, ``offsets``. Every
    output of a batch lives in its own ``batch=<id>`` folder that a retry overwrites, so
    repeating a batch changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        rejected = F.lit(False) if dead is None else F.coalesce(dead, F.lit(False))
        good = batch.where(~rejected)
        where = f"batch={batch_id}"
        write_lake(good, f"{path}/events/{where}", mode="overwrite")
        if dead is not None:
            batch.where(rejected).write.mode("overwrite").parquet(f"{path}/dead_letters/{where}")
        if pk:
            latest_change(good, pk).write.mode("overwrite").parquet(f"{path}/latest/{where}")
        latest_offsets(batch).write.mode("overwrite").parquet(f"{path}/offsets/{where}")
        batch.unpersist()

    return (
        committed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_latest(spark: SparkSession, path: str, pk: list[str]) -> DataFrame:
    """Current rows from the per-batch last changes of ``publish_batches``."""
    batches = spark.read.parquet(f"{path}/latest").drop("batch")
    return latest_change(batches, pk).where(F.col("op") != "DELETE")


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    """Stored restart position per connector; none before the first batch."""
    try:
        saved = spark.read.parquet(f"{path}/offsets")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "connector STRING, connector_type STRING, offset STRING, commit_ord BIGINT")
    # Both from one row, so that they belong to one commit.
    last = F.max_by(F.struct("offset", "commit_ord"), F.struct("batch", "commit_ord")).alias("last")
    return saved.groupBy("connector", "connector_type").agg(last).select("connector", "connector_type", "last.offset", "last.commit_ord")
