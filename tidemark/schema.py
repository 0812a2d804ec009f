"""Schemas and the canonical change event.

Two layouts are used:

* the *log frame*, flat, one row per change or transaction marker, which every
  operator takes and returns (columns in ``LOG_COLUMNS``), and
* the *event*, nested, which sinks publish (``EVENT_SCHEMA``).

``ord`` is the position of a record within its connector, assigned when the log is
landed (dense and increasing); ``ordinal`` is the row number inside a record that
holds several rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tidemark.functions.identity import event_id, offset_map
from tidemark.functions.offsets import offset_value

# Fixed values of the event contract.
DATA_OPERATIONS = ("INSERT", "UPDATE", "DELETE", "READ")
CONTROL_OPERATIONS = ("BEGIN", "COMMIT")
OPERATIONS = DATA_OPERATIONS + CONTROL_OPERATIONS
CONTROL_SCHEMA = "system"
CONTROL_TABLE = "transaction"
SNAPSHOT_TX = "snapshot-tx"
TOAST_SENTINEL = "__TOASTED_VALUE__"

IMAGE = T.MapType(T.StringType(), T.StringType(), True)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("connector", T.StringType()),
        T.StructField("connector_type", T.StringType()),
        T.StructField("database", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("tx", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("ord", T.LongType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("offset", T.StringType()),
        T.StructField("before", IMAGE),
        T.StructField("after", IMAGE),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)
LOG_COLUMNS = LOG_SCHEMA.fieldNames()

SOURCE_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("connectorName", "connectorType", "database", "schema", "table", "transactionId")
    ]
    + [T.StructField("offsetCoordinates", IMAGE)]
)
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("eventId", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("source", SOURCE_SCHEMA),
        T.StructField("before", IMAGE),
        T.StructField("after", IMAGE),
    ]
)


def with_event_id(log: DataFrame) -> DataFrame:
    """Add ``event_id``: the same log position always gets the same id, so a replay
    can be removed downstream."""
    return log.withColumn("event_id", event_id("connector", "offset", "ord", "ordinal"))


def to_event(log: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Log frame → canonical event. ``keep`` names internal columns to carry along."""
    source = F.struct(
        F.col("connector").alias("connectorName"),
        F.col("connector_type").alias("connectorType"),
        F.col("database"),
        F.col("schema"),
        F.col("table"),
        F.col("tx").alias("transactionId"),
        offset_map(F.col("connector_type"), F.col("offset")).alias("offsetCoordinates"),
    )
    return log.select(
        event_id("connector", "offset", "ord", "ordinal").alias("eventId"),
        F.col("op").alias("operation"),
        F.col("ts").alias("timestamp"),
        source.alias("source"),
        F.col("before"),
        F.col("after"),
        *keep,
    )


def from_event(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Canonical event → flat columns, keeping its own ``event_id``. ``ord`` and
    ``ordinal`` are not part of the contract; landed topics add them (see ``keep``)."""
    return events.select(
        F.col("eventId").alias("event_id"),
        F.col("source.connectorName").alias("connector"),
        F.col("source.connectorType").alias("connector_type"),
        F.col("source.database").alias("database"),
        F.col("source.schema").alias("schema"),
        F.col("source.table").alias("table"),
        F.col("source.transactionId").alias("tx"),
        F.col("operation").alias("op"),
        F.col("timestamp").alias("ts"),
        offset_value(F.col("source.offsetCoordinates")).alias("offset"),
        F.col("before"),
        F.col("after"),
        *keep,
    )


def reject_reason(op: str = "op", connector: str = "connector", event_id: str | None = None):
    """Why a row is not a valid event, or null. Required: id, known operation, source."""
    checks = [
        (F.col(op).isNull(), "operation missing"),
        (~F.col(op).isin(*OPERATIONS), "operation unknown"),
        (F.col(connector).isNull(), "source missing"),
    ]
    if event_id is not None:
        checks.insert(0, (F.col(event_id).isNull(), "event id missing"))
    reason = F.lit(None).cast("string")
    for failed, text in reversed(checks):
        reason = F.when(failed, F.lit(text)).otherwise(reason)
    return reason


def control_columns():
    """Schema and table of transaction markers."""
    return [F.lit(CONTROL_SCHEMA).alias("schema"), F.lit(CONTROL_TABLE).alias("table")]
