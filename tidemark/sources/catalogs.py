"""Column catalogs and log segment lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ACTIVE = ("CURRENT", "ACTIVE")


def column_dictionary(info: DataFrame) -> DataFrame:
    """``schema, table, column, position`` → ``schema, table, names`` in position order.

    Repeated catalog rows are removed first, so a list is as long as the table is wide.
    """
    columns = info.select("schema", "table", "column", "position").distinct()
    ordered = columns.groupBy("schema", "table").agg(
        F.array_sort(F.collect_list(F.struct("position", "column"))).alias("columns")
    )
    return ordered.select("schema", "table", F.transform("columns", lambda c: c["column"]).alias("names"))


def prune_log_segments(archived: DataFrame, groups: DataFrame, members: DataFrame, start: int) -> DataFrame:
    """Names of the segments that can hold positions from ``start`` on.

    One copy of each archived (thread, sequence) that ends at or after it, and one member
    of each current or active group, without repeats or blanks.
    """
    old = (
        archived.where((F.col("next_change") >= start) & (F.col("status") == "A"))
        .groupBy("thread", "sequence")
        .agg(F.min("name").alias("name"))
        .select("name")
    )
    online = (
        groups.where(F.col("status").isin(*ACTIVE))
        .join(members, "group")
        .groupBy("group")
        .agg(F.min("member").alias("name"))
        .select("name")
    )
    names = old.union(online).select(F.trim("name").alias("name"))
    return names.where(F.col("name") != "").distinct()


def safe_start(groups: DataFrame) -> DataFrame:
    """Least first position of the current and active groups, else 0."""
    lowest = F.min(F.when(F.col("status").isin(*ACTIVE), F.col("first_change")))
    return groups.agg(lowest.alias("low")).select(
        F.when(F.col("low") > 0, F.col("low")).otherwise(F.lit(0).cast("bigint")).alias("start")
    )
