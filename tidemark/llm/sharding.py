"""Contiguous shards of nearly equal bytes, by global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.store import written

ROW_BITS = 33  # monotonically_increasing_id keeps the row of a partition in its low bits


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_column: str = "doc_id", text_column: str = "text",
                   carry: list[str] | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``size`` (UTF-8 bytes and 8), ``text_crc32``,
    ``law`` ('bytes'), ``shard``, ``slot``, ``grown_shard`` (null), and the ``carry`` columns.

    The rows are ordered by (hash of the text, id) over ranges of that pair, so equal texts
    lie side by side and a text with very many copies still spreads over several ranges.
    Per-range totals give each range its offset in the global byte order; a row goes to the
    shard in which the middle of its bytes falls, so a shard is off its target by at most
    one row at either end. ``slot`` counts rows of a shard in that order.

    Null text: no bytes, the checksum of the empty text. Null ids come first among equal
    texts. Repeated rows: each gets a slot. Empty input: no rows. A row larger than a target
    fills its shard alone and may leave others empty.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("__hash"),
        *[F.col(c).alias(f"__carry_{i}") for i, c in enumerate(carry or [])],
    )
    # The ranges come from a sample, so they are computed once and written.
    ordered = written(
        rows.repartitionByRange(F.col("__hash"), F.col("doc_id"))
        .sortWithinPartitions("__hash", "doc_id")
        .withColumn("__id", F.monotonically_increasing_id())
        .drop("__hash"),
        "shard-order",
    ).withColumns({
        "__range": F.shiftright("__id", ROW_BITS),
        "__row": F.col("__id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)),
    })
    # One row per range: the running totals over them are small whatever the input.
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("__range").agg(F.sum("size").alias("__bytes"), F.count(F.lit(1)).alias("__rows"))
        .withColumns({
            "__bytes_before": F.coalesce(F.sum("__bytes").over(before), F.lit(0)),
            "__rows_before": F.coalesce(F.sum("__rows").over(before), F.lit(0)),
            "__total": F.sum("__bytes").over(Window.partitionBy()),
        })
        .drop("__bytes", "__rows")
    )
    in_range = Window.partitionBy("__range").orderBy("__row").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        ordered.withColumn("__own_before", F.coalesce(F.sum("size").over(in_range), F.lit(0)))
        .join(offsets, "__range")
        .withColumn("__middle", 2 * (F.col("__bytes_before") + F.col("__own_before")) + F.col("size"))
        .withColumns({
            "shard": F.least(F.lit(shards - 1), F.floor(F.col("__middle") * shards / (2 * F.col("__total")))).cast("int"),
            "__index": F.col("__rows_before") + F.col("__row"),
        })
    )
    first = placed.groupBy("shard").agg(F.min("__index").alias("__first"))
    return placed.join(first, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("__index") - F.col("__first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        *[F.col(f"__carry_{i}").alias(c) for i, c in enumerate(carry or [])],
    )
