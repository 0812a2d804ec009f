"""Table snapshots as READ events, and the hand-over from snapshot to log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.images import row_image
from tidemark.functions.offsets import offset_key
from tidemark.operators.positions import usable_offsets
from tidemark.schema import CONTROL_SCHEMA, CONTROL_TABLE, LOG_COLUMNS, LOG_SCHEMA, SNAPSHOT_TX

# Snapshot rows lie before the log, whose positions start at zero.
_FIRST = -(1 << 62)
_COMMIT_AT = -1


def _frame(df: DataFrame, **columns: Column) -> DataFrame:
    types = {f.name: f.dataType for f in LOG_SCHEMA}
    return df.select(*[columns.get(c, F.lit(None)).cast(types[c]).alias(c) for c in LOG_COLUMNS])


def snapshot_rows(df: DataFrame, connector: str, connector_type: str, database: str, schema: str,
                  table: str, offset: str, taken_at: Column, position: Column | None = None,
                  ordinal: int = 0) -> DataFrame:
    """Rows of one table as READ rows with all values as text.

    ``position`` is a number below 2**62 that is unique in the table, such as its key; it
    makes the event ids repeatable. The default is unique, but repeats only as long as the
    input splits the same way. ``ordinal`` tells the tables of one snapshot apart.
    """
    place = position if position is not None else F.monotonically_increasing_id()
    return _frame(
        df,
        connector=F.lit(connector), connector_type=F.lit(connector_type), database=F.lit(database),
        schema=F.lit(schema), table=F.lit(table), tx=F.lit(SNAPSHOT_TX), op=F.lit("READ"), ts=taken_at,
        ord=place + F.lit(_FIRST), ordinal=F.lit(ordinal), offset=F.lit(offset), after=row_image(df),
        ingested_at=taken_at,
    )


def snapshot_events(spark: SparkSession, tables: dict[tuple[str, str], DataFrame], connector: str,
                    connector_type: str, database: str, offset: str, taken_at: Column,
                    positions: dict[tuple[str, str], Column] | None = None) -> DataFrame:
    """All tables (keyed by schema and name) as one pseudo-transaction: BEGIN, a READ per
    row, COMMIT."""
    positions = positions or {}
    rows = [
        snapshot_rows(df, connector, connector_type, database, schema, table, offset, taken_at,
                      positions.get((schema, table)), i)
        for i, ((schema, table), df) in enumerate(tables.items())
    ]
    markers = spark.createDataFrame([("BEGIN", _FIRST - 1), ("COMMIT", _COMMIT_AT)], "op STRING, ord BIGINT")
    control = _frame(
        markers,
        connector=F.lit(connector), connector_type=F.lit(connector_type), database=F.lit(database),
        schema=F.lit(CONTROL_SCHEMA), table=F.lit(CONTROL_TABLE), tx=F.lit(SNAPSHOT_TX), op=F.col("op"),
        ts=taken_at, ord=F.col("ord"), ordinal=F.lit(0), offset=F.lit(offset), ingested_at=taken_at,
    )
    return reduce(DataFrame.unionByName, [control, *rows])


def jdbc_options(url: str, table: str, partition_column: str | None = None, lower: str | int | None = None,
                 upper: str | int | None = None, partitions: int = 1, fetch_size: int = 10_000,
                 session_init: str | None = None, **extra: str) -> dict[str, str]:
    """Options of a snapshot read. ``table`` may be a query in parentheses, e.g. one that
    names an exported snapshot or a point in time.

    Parallel partitions use one connection each and so do not share one transaction. For a
    consistent picture read one partition, or name a fixed point in ``table``, or start the
    log at the position before the read and merge by key, which is idempotent.
    ``session_init`` is a statement each connection starts with, such as one that asks for
    repeatable reads.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if session_init is not None:
        options["sessionInitStatement"] = session_init
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs both bounds")
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower),
                    "upperBound": str(upper), "numPartitions": str(partitions)}
    return options


def read_snapshot_jdbc(spark: SparkSession, url: str, table: str, **settings) -> DataFrame:
    """Source table over JDBC; see ``jdbc_options``."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **settings)).load()


def snapshot_needed(connectors: DataFrame, offsets: DataFrame) -> DataFrame:
    """Connectors without a stored offset; a blank one counts as none."""
    stored = usable_offsets(offsets).select(F.col("connector").alias("name")).distinct()
    return connectors.join(stored, "name", "left_anti")


def snapshot_then_log(snapshot: DataFrame, log: DataFrame, base: str) -> DataFrame:
    """Snapshot rows, then the log rows after the position the snapshot was taken at, and
    those whose offset can't be read."""
    kind = F.col("connector_type")
    here = offset_key(kind, F.col("offset"))
    later = log.where(here.isNull() | (here > offset_key(kind, F.lit(base))))
    return snapshot.unionByName(later)
