"""Topics and message values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.identity import event_json
from tidemark.operators.filters import drop_control
from tidemark.schema import to_event


def topic() -> Column:
    """``cdc.<connector>.<schema>.<table>``; a missing part is written as ``null``."""
    parts = [F.coalesce(F.col(c), F.lit("null")) for c in ("connector", "schema", "table")]
    return F.concat_ws(".", F.lit("cdc"), *parts)


def route(log: DataFrame) -> DataFrame:
    """Add ``topic`` to the rows that are published."""
    return drop_control(log).withColumn("topic", topic())


def messages(log: DataFrame, key: str = "eventId", pk: Column | None = None,
             keep: tuple[str, ...] = ()) -> DataFrame:
    """``topic``, ``key``, ``value`` of each published row.

    ``key="pk"`` uses the given key expression, which keeps the changes of one row in one
    partition of the topic; the default key is the event id.
    """
    if key == "pk" and pk is None:
        raise ValueError("key='pk' needs the key expression")
    routed = route(log).withColumn("__pk", pk.cast("string") if pk is not None else F.lit(None).cast("string"))
    events = to_event(routed, keep=("topic", "__pk", *keep))
    message_key = F.col("__pk") if key == "pk" else F.col("eventId")
    return events.select("topic", message_key.alias("key"), event_json().alias("value"), *keep)
