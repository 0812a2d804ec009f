"""Restart positions per connector."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.offsets import offset_key
from tidemark.operators.joins import side_join


def latest_offsets(committed: DataFrame) -> DataFrame:
    """Offset of the last commit that published rows, per connector. A commit without
    rows leaves no trace in ``committed`` and so saves nothing."""
    return committed.groupBy("connector", "connector_type").agg(
        F.max_by("commit_offset", "commit_ord").alias("offset"),
        F.max("commit_ord").alias("commit_ord"),
    )


def usable_offsets(offsets: DataFrame) -> DataFrame:
    """Stored offsets that hold a value; a blank one counts as missing."""
    return offsets.where(F.trim("offset") != "").withColumn("offset", F.trim("offset"))


def resume(log: DataFrame, offsets: DataFrame, inclusive: bool = True) -> DataFrame:
    """Rows from each connector's stored position on; all rows of a connector without
    one. The position itself is read again (``inclusive``), duplicates are removed later.

    Rows whose own offset is missing or malformed are kept, as it is not known that they were
    read. Of several stored positions of a connector the greatest holds."""
    stored = usable_offsets(offsets).groupBy("connector").agg(F.collect_set("offset").alias("__stored"))
    joined = side_join(log, stored, ["connector"], "left")
    here = offset_key(F.col("connector_type"), F.col("offset"))
    start = F.array_max(F.transform("__stored", lambda o: offset_key(F.col("connector_type"), o)))
    reached = here >= start if inclusive else here > start
    return joined.where(start.isNull() | here.isNull() | reached).drop("__stored")


def scn_position(redo: DataFrame) -> DataFrame:
    """Highest position read per connector, counting records of ignored operations."""
    read = redo.where(F.col("sql_redo").isNotNull() & (F.length("sql_redo") > 0))
    return read.groupBy("connector").agg(F.max("scn").alias("scn"))


def current_position(log: DataFrame) -> DataFrame:
    """Latest position read per connector, committed or not."""
    key = offset_key(F.col("connector_type"), F.col("offset"))
    return log.groupBy("connector", "connector_type").agg(F.max_by("offset", key).alias("offset"))
