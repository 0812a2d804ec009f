"""Row filters, duplicate removal inside one position, and the dead-letter split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.redo import obfuscate_sql
from tidemark.operators.joins import side_join
from tidemark.schema import CONTROL_SCHEMA

FINGERPRINT = ["connector", "scn", "operation", "table_name", "sql_redo"]


def database_filter(df: DataFrame, database: str, column: str = "db") -> DataFrame:
    """Rows of one database."""
    return df.where(F.col(column) == database)


def owner_filter(redo: DataFrame, owner: str, start: int, container: str | None = None) -> DataFrame:
    """Redo rows of one owner from a position on, in one container when given."""
    kept = redo.where((F.col("seg_owner") == owner.upper()) & (F.col("scn") >= start))
    if container is not None and container.strip():
        kept = kept.where(F.col("src_con_name") == container.upper())
    return kept


def drop_control(log: DataFrame) -> DataFrame:
    """Leave out transaction markers, which are neither published nor counted. A row
    without a schema is data."""
    return log.where(~F.col("schema").eqNullSafe(CONTROL_SCHEMA))


def tables_in_scope(log: DataFrame, published: DataFrame) -> DataFrame:
    """Rows of the published tables (``schema``, ``table``)."""
    return side_join(log, published.select("schema", "table").distinct(), ["schema", "table"], "left_semi")


def dedup_fingerprint(redo: DataFrame, keys: list[str] | None = None, order: str | None = None) -> DataFrame:
    """One row per statement at one position, the earliest by ``order`` when given.

    The transaction is not part of the default keys, so two equal statements at one
    position collapse; pass ``keys`` to widen. Copies are reduced before the shuffle.
    """
    keys = keys or FINGERPRINT
    if order is None:
        return redo.dropDuplicates(keys)
    first = redo.groupBy(*keys).agg(F.min_by(F.struct(*redo.columns), F.col(order)).alias("row"))
    return first.select("row.*")


def dlq_topic(connector: Column) -> Column:
    return F.concat_ws(".", F.lit("cdc"), F.lit("dlq"), connector)


def split_dlq(rows: DataFrame, reason: Column, payload: Column) -> tuple[DataFrame, DataFrame]:
    """Split into good rows and dead letters (``topic``, ``connector``, ``reason``,
    ``payload`` with its literals masked, ``ord``). Both are filters of the same input, so
    no row is lost and positions advance over bad rows too."""
    good = rows.where(reason.isNull())
    dead = rows.where(reason.isNotNull()).select(
        dlq_topic(F.col("connector")).alias("topic"),
        F.col("connector"),
        reason.alias("reason"),
        obfuscate_sql(payload).alias("payload"),
        F.col("ord"),
    )
    return good, dead
