"""Postgres: tables of logical-replication message bytes → log frame.

Input columns: ``connector, database, ord, offset, payload BINARY, ingested_at``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.binding import with_once
from tidemark.functions.images import name_columns
from tidemark.functions.pgbytes import char, int64, pg_timestamp, pg_tuple, relation_definition, uint
from tidemark.operators.ordered import BIN_BITS, Carry, carry
from tidemark.schema import CONTROL_SCHEMA, CONTROL_TABLE, LOG_COLUMNS

# First byte of the messages that matter, and the operation each stands for.
MESSAGE_OPERATIONS = {"B": "BEGIN", "C": "COMMIT", "I": "INSERT", "U": "UPDATE", "D": "DELETE"}
RELATION = "R"
ROW_MESSAGES = ("I", "U", "D")
NO_TRANSACTION = "0"


def pg_messages(raw: DataFrame) -> DataFrame:
    """Header fields of each message: ``type``, ``relation_id``, ``xid``, ``event_ts`` and,
    for a relation message, ``definition``. Other and empty messages are dropped."""
    payload = F.col("payload")
    kind = char(payload, 1)
    known = raw.where(kind.isin(*MESSAGE_OPERATIONS, RELATION)).withColumn("type", kind)
    kind = F.col("type")
    return known.withColumns(
        {
            "relation_id": F.when(kind.isin(*ROW_MESSAGES, RELATION), uint(payload, 2, 4)),
            "xid": F.when(kind == "B", uint(payload, 18, 4)),
            "event_ts": F.when(kind == "B", pg_timestamp(int64(payload, 10))).when(
                kind == "C", pg_timestamp(int64(payload, 19))
            ),
            "definition": F.when(kind == RELATION, relation_definition(payload)),
        }
    )


def resolve(messages: DataFrame, bits: int = BIN_BITS) -> DataFrame:
    """Add what each message owes to its neighbours in the log.

    ``relation``  latest definition of its relation before it
    ``tx``        transaction of the enclosing BEGIN
    ``commit_*``  the commit that closes it; null when the next marker is another BEGIN

    One shuffle by (connector, bin of positions) serves all of them.
    """
    kind = F.col("type")
    opened = F.when(kind == "B", F.struct(F.lit(True).alias("open"), F.col("xid").alias("xid"))).when(
        kind == "C", F.struct(F.lit(False).alias("open"), F.lit(None).cast("bigint").alias("xid"))
    )
    marker = F.when(
        kind.isin("B", "C"),
        F.struct(
            kind.alias("type"), F.col("ord").alias("ord"), F.col("event_ts").alias("ts"), F.col("offset").alias("offset")
        ),
    )
    found = carry(
        messages,
        ["connector"],
        ["ord"],
        [
            Carry("opened", opened),
            # A COMMIT belongs to the transaction it closes.
            Carry("opened_before", opened, strict=True),
            Carry("closing", marker, ahead=True),
            Carry("relation", F.col("definition"), by=("relation_id",)),
        ],
        bits,
    )
    enclosing = F.when(kind == "C", F.col("opened_before")).otherwise(F.col("opened"))
    closed = F.when((F.col("closing.type") == "C") & kind.isin(*ROW_MESSAGES), F.col("closing"))
    return found.withColumns(
        {
            "tx": F.coalesce(enclosing["xid"].cast("string"), F.lit(NO_TRANSACTION)),
            "commit_ord": closed["ord"],
            "commit_ts": closed["ts"],
            "commit_offset": closed["offset"],
        }
    ).drop("opened", "opened_before", "closing")


def decode_tuples(messages: DataFrame) -> DataFrame:
    """Add ``old`` and ``new`` tuples: inserts have the new one, deletes the old one, and
    updates the old one only when the message announces it."""
    payload = F.col("payload")
    kind = F.col("type")
    both = (kind == "U") & char(payload, 6).isin("O", "K")
    first = with_once(
        messages,
        {"__both": both, "__first": F.when(kind.isin(*ROW_MESSAGES), pg_tuple(payload, 7))},
    )
    # The byte between the tuples announces the new one.
    second = with_once(first, {"__second": F.when(F.col("__both"), pg_tuple(payload, F.col("__first.pos") + 1))})
    old = F.when((kind == "D") | F.col("__both"), F.col("__first"))
    new = F.when(F.col("__both"), F.col("__second")).when(kind.isin("I", "U"), F.col("__first"))
    return second.withColumns({"old": old, "new": new}).drop("__both", "__first", "__second")


def pg_events(raw: DataFrame, bits: int = BIN_BITS) -> DataFrame:
    """Message bytes → log frame with ``commit_ord/commit_ts/commit_offset`` and
    ``reason``, which is null for good rows. Relation messages are used up.

    Tuples are decoded after the shuffle, so only the message bytes travel.
    """
    rows = resolve(pg_messages(raw), bits).where(F.col("type") != RELATION)
    decoded = decode_tuples(rows)
    control = F.col("type").isin("B", "C")
    intact = F.coalesce(F.col("old.ok"), F.lit(True)) & F.coalesce(F.col("new.ok"), F.lit(True))
    reason = F.when(~control & F.col("relation").isNull(), F.lit("relation unknown")).when(
        ~control & F.col("relation.names").isNull(), F.lit("relation malformed")
    ).when(
        ~control & ~intact, F.lit("tuple malformed")
    )
    operation = F.element_at(
        F.create_map(*[F.lit(x) for pair in MESSAGE_OPERATIONS.items() for x in pair]), F.col("type")
    )

    def image(side: str):
        return F.when(intact, name_columns(F.col(f"{side}.values"), F.col("relation.names"), "col_unknown_"))

    named = decoded.withColumns(
        {
            "connector_type": F.lit("postgres"),
            "schema": F.when(control, F.lit(CONTROL_SCHEMA)).otherwise(F.col("relation.schema")),
            "table": F.when(control, F.lit(CONTROL_TABLE)).otherwise(F.col("relation.table")),
            "op": operation,
            "ts": F.coalesce("event_ts", "commit_ts", "ingested_at"),
            "ordinal": F.lit(0),
            "before": image("old"),
            "after": image("new"),
            "reason": reason,
        }
    )
    return named.select(*LOG_COLUMNS, "commit_ord", "commit_ts", "commit_offset", "reason", "payload")
