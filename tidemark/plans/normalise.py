"""From landed logs to committed log rows, by kind of source.

A new kind of source is a function from its landed table to the log frame with
``commit_ord, commit_ts, commit_offset`` and ``reason``; register it in ``NORMALISERS``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.filters import dedup_fingerprint, owner_filter, split_dlq
from tidemark.operators.mysql import binlog_events
from tidemark.operators.oracle import redo_events
from tidemark.operators.postgres import pg_events
from tidemark.operators.transactions import is_data


def postgres(raw: DataFrame) -> DataFrame:
    rows = pg_events(raw)
    # The bytes of a bad message stay out of the dead letter; its shape is enough.
    shape = F.concat(F.lit("message of "), F.octet_length("payload").cast("string"), F.lit(" bytes"))
    return rows.withColumn("raw", shape).drop("payload")


def mysql(raw: DataFrame, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    rows = binlog_events(raw, dictionary, database, keep_unmapped=True)
    unmapped = is_data() & F.col("schema").isNull()
    return rows.withColumns(
        {
            "reason": F.when(unmapped, F.lit("table map unknown")),
            "raw": F.when(unmapped, F.concat(F.lit("row event at "), F.col("offset"))),
        }
    )


def oracle(raw: DataFrame, owner: str, start: int = 0, container: str | None = None,
           literal_parity: bool = False) -> DataFrame:
    mine = dedup_fingerprint(owner_filter(raw, owner, start, container), order="ord")
    return redo_events(mine, container, literal_parity).withColumnRenamed("sql_redo", "raw")


NORMALISERS: dict[str, Callable[..., DataFrame]] = {"postgres": postgres, "mysql": mysql, "oracle": oracle}


def normalise(kind: str, raw: DataFrame, **settings) -> DataFrame:
    """Landed log of a kind → log rows with commits and reasons."""
    if kind not in NORMALISERS:
        raise ValueError(f"unknown kind {kind!r}, known: {sorted(NORMALISERS)}")
    return NORMALISERS[kind](raw, **settings)


def publishable(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split normalised rows into committed events, open rows and dead letters. Every data
    row is in exactly one of them."""
    data = rows.where(is_data() | F.col("reason").isNotNull())
    good, dead = split_dlq(data, F.col("reason"), F.col("raw"))
    good = good.drop("reason", "raw")
    return good.where(F.col("commit_ord").isNotNull()), good.where(F.col("commit_ord").isNull()), dead
