"""Restart positions of MySQL logs as sets of executed transactions.

A landed binlog has the id of its transaction in the column ``gtid`` of its rows. Unlike a file
and a position, a set of them means the same on every server of a group, and it can say
that an earlier transaction is still missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import gtid as ids
from tidemark.functions.offsets import offset_key
from tidemark.operators.joins import side_join
from tidemark.operators.mysql import binlog_position, is_commit
from tidemark.operators.ordered import Carry, carry
from tidemark.operators.positions import usable_offsets

BIN_BITS = 12  # numbers collected together
ID = ["connector", "__server", "__number"]


def gtid_sets(rows: DataFrame, keys: list[str], column: str = "gtid") -> DataFrame:
    """The set of all ids of a text column, per key, as ``gtids``. Texts that are no id count
    for nothing; a key without ids has no row.

    Numbers are first joined within bins, of at most 2^12 numbers each, then the intervals of
    the bins: what meets per key and server is as many intervals as bins and gaps."""
    known = rows.select(*keys, ids.gtid_parts(F.col(column)).alias("__id")).where(F.col("__id").isNotNull())
    numbers = known.select(*keys, F.col("__id.server").alias("__server"), F.col("__id.number").alias("__number"))
    bins = numbers.groupBy(*keys, "__server", F.shiftright("__number", BIN_BITS).alias("__bin")).agg(
        ids.numbers_to_runs(F.collect_set("__number")).alias("__runs")
    )
    servers = bins.groupBy(*keys, "__server").agg(ids.joined(F.flatten(F.collect_list("__runs"))).alias("__runs"))
    entries = F.array_sort(F.collect_list(F.struct("__server", "__runs")))
    return servers.groupBy(*keys).agg(F.map_from_entries(entries).alias("gtids"))


def gtid_offsets(binlog: DataFrame) -> DataFrame:
    """Offset per connector: the set of the transactions whose commit was read."""
    found = gtid_sets(binlog.where(is_commit()), ["connector"])
    return found.select("connector", F.lit("mysql").alias("connector_type"), ids.gtid_text(F.col("gtids")).alias("offset"))


def resume_binlog(binlog: DataFrame, offsets: DataFrame) -> DataFrame:
    """Landed rows that are still to be read, given stored offsets (``connector, offset``).

    With sets, the rows of transactions outside all sets of the connector; with a file and
    position only, the rows from the greatest on; without either, all. Rows without a readable id,
    such as table maps, are kept under sets, as it is not known that they were read. Of several
    stored sets the union holds, and sets take precedence over positions."""
    parsed = usable_offsets(offsets).select(
        "connector",
        ids.gtid_set(F.col("offset")).alias("gtids"),
        offset_key(F.lit("mysql"), F.col("offset")).alias("__start"),
    )
    has_set = F.coalesce(F.max(F.size(F.map_keys("gtids")) > 0), F.lit(False))
    starts = parsed.groupBy("connector").agg(F.max("__start").alias("__start"), has_set.alias("__has_set"))
    starts = starts.where(~F.col("__has_set")).drop("__has_set")

    found = ids.gtid_parts(F.col("gtid"))
    placed = binlog.withColumns({"__server": found["server"], "__number": found["number"]})
    rest = side_join(placed, _executed(placed.select(*ID), parsed), ID, "left_anti")
    rows = side_join(rest, starts, ["connector"], "left")
    here = offset_key(F.lit("mysql"), binlog_position())
    return rows.where(~F.coalesce(here < F.col("__start"), F.lit(False))).select(*binlog.columns)


def _executed(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Ids of rows that are in a stored set of their connector.

    Sets may have as many intervals as the log has transactions, so no row searches a set:
    each interval is a step up at its start and one down after its end, and a running sum
    over the numbers tells how many intervals an id is in."""
    parts = stored.select("connector", F.explode("gtids").alias("__server", "__iv"))
    bounds = parts.select("connector", "__server", F.inline("__iv")).select(
        "connector", "__server",
        F.inline(F.array(
            F.struct(F.col("lo").alias("__number"), F.lit(1).cast("bigint").alias("__step")),
            F.struct((F.col("hi") + 1).alias("__number"), F.lit(-1).cast("bigint").alias("__step")),
        )),
    )
    steps = bounds.groupBy(*ID).agg(F.sum("__step").alias("__step"))
    known = rows.where(F.col("__number").isNotNull()).distinct()
    together = steps.unionByName(known, allowMissingColumns=True).withColumn("__is_id", F.col("__step").isNull())
    within = carry(together, ID[:2], ["__number", "__is_id"], [Carry("__depth", F.col("__step"), total=True)])
    return within.where(F.col("__is_id") & (F.col("__depth") > 0)).select(*ID)
