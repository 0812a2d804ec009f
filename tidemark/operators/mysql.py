"""MySQL: tables of binlog events → log frame.

Input columns: ``connector, server_id, ord, file, pos, event, header_ts, table_id, db,
table, sql, rows ARRAY<STRUCT<before ARRAY<STRING>, after ARRAY<STRING>>>, ingested_at``
where ``event`` is one of TABLE_MAP, WRITE, UPDATE, DELETE, XID, QUERY; ``gtid``, the id of the
transaction, if it was landed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.images import name_columns
from tidemark.operators.joins import side_join
from tidemark.operators.ordered import BIN_BITS, Carry, carry
from tidemark.schema import CONTROL_SCHEMA, CONTROL_TABLE, LOG_COLUMNS

ROW_EVENTS = {"WRITE": "INSERT", "UPDATE": "UPDATE", "DELETE": "DELETE"}


def is_commit() -> Column:
    """An XID event, or the statement COMMIT in any spelling."""
    statement = F.upper(F.trim(F.col("sql"))) == "COMMIT"
    return (F.col("event") == "XID") | ((F.col("event") == "QUERY") & F.coalesce(statement, F.lit(False)))


def binlog_position() -> Column:
    return F.concat_ws(":", F.col("file"), F.col("pos").cast("string"))


def header_tx() -> Column:
    """Transaction id from server and header second, which merges the transactions of
    one second."""
    return F.concat_ws("-", F.lit("tx"), F.col("server_id").cast("string"),
                       F.unix_millis("header_ts").cast("string"))


def resolve(log: DataFrame, mode: str = "positional", bits: int = BIN_BITS) -> DataFrame:
    """Add ``mapped`` (database and table of the latest table map with the row's id),
    ``tx`` and, for ``mode="positional"``, the closing commit.

    ``positional`` numbers transactions by the commits before them; ``landed`` takes the id
    landed in ``gtid``, which stays the same wherever reading starts, and the number only for
    rows without one; ``header`` builds the id from the event header, and commits must then be
    found by ``commit_gate``.
    """
    if mode not in ("positional", "landed", "header"):
        raise ValueError(f"unknown mode {mode!r}")
    commit = is_commit()
    table_map = F.when(F.col("event") == "TABLE_MAP", F.struct(F.col("db").alias("db"), F.col("table").alias("table")))
    values = [Carry("mapped", table_map, by=("table_id",))]
    if mode != "header":
        closing = F.struct(
            F.col("ord").alias("ord"), F.col("header_ts").alias("ts"), binlog_position().alias("offset")
        )
        values += [
            Carry("commits_before", commit.cast("bigint"), strict=True, total=True),
            Carry("closing", F.when(commit, closing), ahead=True),
        ]
    # Only markers carry statements, and only table maps and commits are markers.
    wanted = log.where(F.col("event").isin("TABLE_MAP", *ROW_EVENTS) | commit)
    found = carry(wanted, ["connector"], ["ord"], values, bits)
    if mode == "header":
        missing = {c: F.lit(None).cast(t) for c, t in
                   (("commit_ord", "bigint"), ("commit_ts", "timestamp"), ("commit_offset", "string"))}
        return found.withColumns({"tx": header_tx(), **missing})
    closed = F.when(F.col("event").isin(*ROW_EVENTS), F.col("closing"))
    number = F.col("commits_before").cast("string")
    return found.withColumns(
        {
            "tx": F.coalesce(F.lower(F.trim("gtid")), number) if mode == "landed" else number,
            "commit_ord": closed["ord"],
            "commit_ts": closed["ts"],
            "commit_offset": closed["offset"],
        }
    ).drop("commits_before", "closing")


def binlog_events(log: DataFrame, dictionary: DataFrame, database: str | None = None,
                  mode: str = "positional", bits: int = BIN_BITS, keep_unmapped: bool = False) -> DataFrame:
    """Binlog events → log frame with ``commit_*`` columns (null in header mode).

    ``dictionary`` has ``schema, table, names``. Rows of other databases are dropped when
    ``database`` is given, before rows are unpacked. A row event without a table map is
    dropped too, or kept as one row without schema, table and images.
    """
    resolved = resolve(log, mode, bits)
    data_event = F.col("event").isin(*ROW_EVENTS)
    mapped = F.col("mapped").isNotNull()
    here = F.lit(True) if database is None else F.col("mapped.db") == database
    usable = resolved.where(~data_event | (mapped & here) | (~mapped & F.lit(keep_unmapped)))
    names = dictionary.select(
        F.col("schema").alias("__db"), F.col("table").alias("__table"), F.col("names").alias("__names")
    )
    placed = usable.withColumns(
        {
            "__db": F.when(data_event, F.col("mapped.db")),
            "__table": F.when(data_event, F.col("mapped.table")),
        }
    )
    named = side_join(placed, names, ["__db", "__table"], "left")
    # Markers have no row list; they pass through with one empty row.
    unpacked = named.select("*", F.posexplode_outer(F.when(data_event & mapped, F.col("rows"))).alias("__pos", "__row")).where(
        ~data_event | ~mapped | F.col("__row").isNotNull()
    )
    operation = F.when(data_event, F.element_at(
        F.create_map(*[F.lit(x) for pair in ROW_EVENTS.items() for x in pair]), F.col("event")
    )).when(F.col("event") == "TABLE_MAP", F.lit("BEGIN")).otherwise(F.lit("COMMIT"))
    marker_db = F.coalesce(F.col("db"), F.lit(database).cast("string"))

    def image(side: str, absent_for: str):
        values = F.when(F.col("event") != absent_for, F.col(f"__row.{side}"))
        return name_columns(values, F.col("__names"), "col_")

    return unpacked.withColumns(
        {
            "connector_type": F.lit("mysql"),
            "database": F.when(data_event, F.col("__db")).otherwise(marker_db),
            "schema": F.when(data_event, F.col("__db")).otherwise(F.lit(CONTROL_SCHEMA)),
            "table": F.when(data_event, F.col("__table")).otherwise(F.lit(CONTROL_TABLE)),
            "op": operation,
            "ts": F.coalesce("commit_ts", "header_ts", "ingested_at"),
            "ordinal": F.coalesce("__pos", F.lit(0)),
            "offset": binlog_position(),
            "before": image("before", absent_for="WRITE"),
            "after": image("after", absent_for="DELETE"),
        }
    ).select(*LOG_COLUMNS, "commit_ord", "commit_ts", "commit_offset")
