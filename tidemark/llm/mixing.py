"""Mixing sources to target weights with weighted sampling keys (Efraimidis and Spirakis)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.store import written
from tidemark.llm.texts import count_words, symbol_count

BINS = 4096


def quality_weight(text: Column) -> Column:
    """Weight of a document between 0.1 and 1: less for texts full of symbols."""
    size = F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.1), 1 - 5 * symbol_count(text) / size)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``source``, ``source_size`` to these and ``target`` (double), ``epochs``, ``rest``.

    Sources by code point, null last, weigh ``weights`` in turn. A target is
    least(most * size, level * weight); the level is the one at which the targets add up to
    all words, which is what sharing out the excess again and again comes to. One row per
    source, so the running sums over all of them are small beside the documents.
    """
    ranked = sizes.withColumn("__n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("__n") - 1) % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    before = Window.orderBy("__ratio", "__n").rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        ranked.withColumn("__w", weight)
        .withColumn("__cap", most * F.col("source_size"))
        .withColumn("__ratio", F.col("__cap") / F.col("__w"))
        .withColumn("__level", (F.sum("source_size").over(every) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
                    / (F.sum("__w").over(every) - F.coalesce(F.sum("__w").over(before), F.lit(0.0))))
        .withColumn("__level", F.min(F.when(F.col("__level") <= F.col("__ratio"), F.struct("__ratio", "__n", "__level"))).over(every)["__level"])
    )
    target = F.least(F.col("__cap"), F.col("__level") * F.col("__w"))
    return (
        levels.withColumn("target", F.coalesce(target, F.col("__cap")))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")))
        .select("source", "source_size", "target", "epochs", "rest")
    )


def sampling_keys(docs: DataFrame, seed: int, id_column: str, text_column: str, source_column: str) -> dict[str, Column]:
    """Columns by name: id, source, size, the exponential key -ln(u) / weight and its bin."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    bits = F.xxhash64(F.lit(seed), F.col(id_column), F.xxhash64(text))
    uniform = (F.pmod(bits, F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return {
        "doc_id": F.col(id_column),
        "source": F.col(source_column),
        "size": count_words(text).cast("long"),
        "key": -F.log(uniform) / quality_weight(text),
    }


def bin_of(key: Column, bins: int = BINS) -> Column:
    """Increasing in the key, and nearly even for unit weights."""
    return F.least(F.lit(bins - 1), F.floor(bins * (1 - F.exp(-key)))).cast("int")


def mix_cuts(keyed: DataFrame, bins: int = BINS) -> DataFrame:
    """Per source: targets, whole epochs, and the place (``cut_bin``, ``cut``) in the key
    order up to which documents are taken once more.

    Totals per (source, bin of the key) find the bin in which the budget ends; only the rows
    of that bin are then sorted. So a source with a third of all rows is never sorted whole.
    """
    totals = written(keyed.groupBy("source", "bin").agg(F.sum("size").alias("words")), "mix-bins")
    targets = source_targets(totals.groupBy("source").agg(F.sum("words").alias("source_size")))
    by_bin = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bounds = totals.withColumn("before", F.coalesce(F.sum("words").over(by_bin), F.lit(0))).alias("b")
    t = targets.alias("t")
    ends = bounds.join(t, F.col("b.source").eqNullSafe(F.col("t.source"))).where(
        (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))
    ).select(F.col("t.source").alias("source"), F.col("b.bin").alias("cut_bin"), (F.col("rest") - F.col("before")).alias("left"))
    ends = written(ends, "mix-ends")
    k, e = keyed.alias("k"), ends.alias("e")
    in_bin = Window.partitionBy("source").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        k.join(e, F.col("k.source").eqNullSafe(F.col("e.source")) & (F.col("k.bin") == F.col("e.cut_bin")))
        .select(F.col("k.source").alias("source"), "key", "doc_id", "size", "left")
        .withColumn("middle", F.coalesce(F.sum("size").over(in_bin), F.lit(0)) + F.col("size") / 2)
        .where(F.col("middle") <= F.col("left"))
        .groupBy("source").agg(F.max(F.struct("key", "doc_id")).alias("cut"))
    )
    c = cuts.alias("c")
    return (
        t.join(e, F.col("t.source").eqNullSafe(F.col("e.source")), "left")
        .join(c, F.col("t.source").eqNullSafe(F.col("c.source")), "left")
        .select(F.col("t.source").alias("__source"), "source_size", "target", "epochs", "cut_bin", "cut")
    )


def copies() -> Column:
    """How often a keyed row beside its source's cut is taken."""
    once_more = (F.col("bin") < F.col("cut_bin")) | ((F.col("bin") == F.col("cut_bin")) & (F.struct("key", "doc_id") <= F.col("cut")))
    return F.col("epochs") + F.coalesce(once_more, F.lit(False)).cast("long")


def mix(docs: DataFrame, seed: int = 17, id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source") -> DataFrame:
    """One row per input row: ``doc_id``, ``size`` (words), ``source_size``, ``target``,
    ``taken`` (words the mix takes, repeats counted), ``copies``.

    Every document of a source is taken as often as whole epochs fit into its target; the
    rest goes to the documents with the smallest keys, up to the one at which the budget is
    met most nearly. Keys come from a hash of seed, id and text, so reruns agree.

    Null source: a source of its own, last in order. Null or empty text: size 0. Repeated
    rows have equal keys and are taken together. Empty input: no rows.
    """
    columns = sampling_keys(docs, seed, id_column, text_column, source_column)
    keyed = written(docs.select(*[c.alias(n) for n, c in columns.items()]).withColumn("bin", bin_of(F.col("key"))), "mix-keys")
    cuts = written(mix_cuts(keyed), "mix-cuts")
    joined = keyed.join(cuts, F.col("source").eqNullSafe(F.col("__source"))).withColumn("copies", copies())
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The documents themselves, each repeated as often as the mix takes it. The texts do
    not move: each row is compared with the cut of its source."""
    columns = sampling_keys(docs, seed, "doc_id", "text", "source")
    keyed = written(docs.select(*[c.alias(n) for n, c in columns.items()]).withColumn("bin", bin_of(F.col("key"))), "mix-keys")
    cuts = written(mix_cuts(keyed), "mix-cuts")
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("__row")
    rows = docs.select(row, columns["doc_id"].alias("doc_id"), columns["source"].alias("source"), columns["key"].alias("key"))
    rows = rows.withColumn("bin", bin_of(F.col("key"))).join(cuts, F.col("source").eqNullSafe(F.col("__source")))
    times = F.explode(F.sequence(F.lit(1), copies().cast("int")))
    return rows.where(copies() > 0).withColumn("__copy", times).select("__row.*")
