"""Landed change logs, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.binding import with_once
from tidemark.schema import EVENT_SCHEMA, LOG_SCHEMA, from_event, reject_reason

# Landed columns of each kind of log.
PG_SCHEMA = (
    "connector STRING, database STRING, ord BIGINT, offset STRING, payload BINARY, ingested_at TIMESTAMP"
)
BINLOG_SCHEMA = (
    "connector STRING, server_id BIGINT, ord BIGINT, file STRING, pos BIGINT, event STRING, "
    "header_ts TIMESTAMP, table_id BIGINT, db STRING, table STRING, sql STRING, "
    "rows ARRAY<STRUCT<before: ARRAY<STRING>, after: ARRAY<STRING>>>, ingested_at TIMESTAMP, "
    "gtid STRING"
)
REDO_SCHEMA = (
    "connector STRING, ord BIGINT, scn BIGINT, sql_redo STRING, operation STRING, table_name STRING, "
    "seg_owner STRING, src_con_name STRING, tx_name STRING, timestamp TIMESTAMP, ingested_at TIMESTAMP"
)
LANDED_SCHEMAS = {"postgres": PG_SCHEMA, "mysql": BINLOG_SCHEMA, "oracle": REDO_SCHEMA, "log": LOG_SCHEMA}


def read_change_log(spark: SparkSession, path: str, kind: str, fmt: str = "parquet") -> DataFrame:
    """Landed log of one kind (see ``LANDED_SCHEMAS``)."""
    return spark.read.schema(LANDED_SCHEMAS[kind]).format(fmt).load(path)


def stream_change_log(spark: SparkSession, path: str, kind: str, fmt: str = "parquet",
                      max_files: int | None = None) -> DataFrame:
    """The same as a stream of files."""
    reader = spark.readStream.schema(LANDED_SCHEMAS[kind]).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def kafka_source_options(servers: str, topics: str, starting: str = "earliest", **extra: str) -> dict[str, str]:
    """Options of a Kafka read; ``topics`` is a pattern such as ``cdc\\..*``."""
    return {"kafka.bootstrap.servers": servers, "subscribePattern": topics, "startingOffsets": starting, **extra}


def kafka_rows(raw: DataFrame) -> DataFrame:
    """Kafka records → ``value, topic, partition, ord, ingested_at``. ``ord`` is the offset,
    which is unique and ordered within a topic's partition only: order and keys are
    (topic, partition, ord)."""
    return raw.select(
        F.col("value").cast("string").alias("value"),
        "topic", "partition",
        F.col("offset").alias("ord"),
        F.col("timestamp").alias("ingested_at"),
    )


def read_kafka(spark: SparkSession, servers: str, topics: str, stream: bool = False, **extra: str) -> DataFrame:
    """Published events from Kafka, see ``kafka_rows``; needs Spark's Kafka package on the
    class path."""
    reader = (spark.readStream if stream else spark.read).format("kafka")
    return kafka_rows(reader.options(**kafka_source_options(servers, topics, **extra)).load())


def events_from_json(texts: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Event JSON → flat columns with ``reason``, null for valid events. Text that is not
    JSON and events without their required fields stay in the frame with a reason."""
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    doc = F.from_json(F.col("raw"), schema, {"columnNameOfCorruptRecord": "_corrupt"})
    parsed = with_once(texts.select(F.col(column).alias("raw"), *keep), {"__doc": doc})
    flat = from_event(parsed.select("__doc.*", "raw", *keep), keep=("raw", "_corrupt", *keep))
    broken = F.when(F.col("_corrupt").isNotNull() | F.col("raw").isNull(), F.lit("not JSON"))
    return flat.withColumn("reason", F.coalesce(broken, reject_reason(event_id="event_id"))).drop("_corrupt")
