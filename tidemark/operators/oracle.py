"""Oracle: tables of mined redo records → log frame.

Input columns: ``connector, ord, scn, sql_redo, operation, table_name, seg_owner,
src_con_name, tx_name, timestamp, ingested_at``. Mined records are committed already, so
each row is its own commit and no gate is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.binding import with_once
from tidemark.functions.images import delta
from tidemark.functions.redo import parse_delete, parse_insert, parse_update, raw_image
from tidemark.schema import LOG_COLUMNS

REDO_OPERATIONS = ("INSERT", "UPDATE", "DELETE")


def redo_rows(redo: DataFrame) -> DataFrame:
    """Records of the three data operations with text, and their transaction id."""
    has_text = F.col("sql_redo").isNotNull() & (F.trim("sql_redo") != "")
    kept = redo.where(has_text & F.col("operation").isin(*REDO_OPERATIONS))
    return kept.withColumn("tx", F.coalesce("tx_name", F.concat(F.lit("ora-tx-"), F.col("scn").cast("string"))))


def redo_images(rows: DataFrame, literal_parity: bool = False) -> DataFrame:
    """Add ``before``, ``after`` and ``reason``. Text that is not understood is carried
    whole under ``raw_sql``; updates keep only the columns that changed."""
    sql, op = F.col("sql_redo"), F.col("operation")
    parsed = with_once(
        rows,
        {
            "__insert": F.when(op == "INSERT", parse_insert(sql, literal_parity)),
            "__update": F.when(op == "UPDATE", parse_update(sql, literal_parity)),
            "__delete": F.when(op == "DELETE", parse_delete(sql, literal_parity)),
        },
    )
    understood = F.coalesce("__insert", "__delete", F.col("__update.before")).isNotNull()
    before = F.when(op == "UPDATE", F.coalesce(F.col("__update.before"), F.create_map().cast("map<string,string>"))).when(
        op == "DELETE", F.coalesce(F.col("__delete"), raw_image(sql))
    )
    after = F.when(
        op == "UPDATE",
        F.coalesce(delta(F.col("__update.before"), F.col("__update.assigned")), raw_image(sql)),
    ).when(op == "INSERT", F.coalesce(F.col("__insert"), raw_image(sql)))
    return parsed.withColumns(
        {"before": before, "after": after, "reason": F.when(~understood, F.lit("statement not understood"))}
    ).drop("__insert", "__update", "__delete")


def redo_events(redo: DataFrame, container: str | None = None, literal_parity: bool = False) -> DataFrame:
    """Redo records → log frame with ``commit_*`` columns and ``reason``."""
    rows = redo_images(redo_rows(redo), literal_parity)
    # Without a configured container the owner doubles as the database name.
    database = F.lit(container.upper()) if container and container.strip() else F.col("seg_owner")
    scn = F.col("scn").cast("string")
    return rows.withColumns(
        {
            "connector_type": F.lit("oracle"),
            "database": database,
            "schema": F.col("seg_owner"),
            "table": F.col("table_name"),
            "op": F.col("operation"),
            "ts": F.coalesce("timestamp", "ingested_at"),
            "ordinal": F.lit(0),
            "offset": scn,
            "commit_ord": F.col("ord"),
            "commit_ts": F.col("timestamp"),
            "commit_offset": scn,
        }
    ).select(*LOG_COLUMNS, "commit_ord", "commit_ts", "commit_offset", "reason", "sql_redo")
