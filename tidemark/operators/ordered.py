"""Values carried along an ordered log, without putting a whole group in one task.

"The last table definition before this row", "the next commit of this transaction",
"how many commits so far": each is a running value over the rows of a group in log
order. A plain window over (connector) or (transaction) would sort a whole group in
one task, and one group may hold a third of the log.

``carry`` cuts each group into bins of ``2**bits`` log positions and lets the windows
run over (group, bin), so a task never holds more than a bin's rows of one group. What
a bin must know about the bins before it is computed first, on a few narrow columns,
as one summary row per (group, bin): a group of 10**11 rows has fewer than 400 000 of
them. The results enter the windows as extra *seed* rows at the start of each bin, which
needs no join: rows and seeds are shuffled together, once, and the seeds are dropped
afterwards.

Positions are expected to be dense. Where they are not (byte positions, say), bins hold
fewer rows and there are more of them; ``levels=2`` cuts the summaries into bins as well.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# 262 144 positions per bin.
BIN_BITS = 18

_BIN = "__bin"
_IS_ROW = "__is_row"


@dataclass(frozen=True)
class Carry:
    """One running value.

    ``value``   what a row contributes; null contributes nothing
    ``by``      keys that narrow the group beyond the common key
    ``ahead``   look at later rows instead of earlier ones
    ``strict``  leave out the row itself
    ``total``   running sum instead of the nearest value
    """

    name: str
    value: Column
    by: tuple[str, ...] = ()
    ahead: bool = False
    strict: bool = False
    total: bool = False


def _ordering(order: list[str], ahead: bool) -> list[Column]:
    return [F.col(c).desc() if ahead else F.col(c).asc() for c in order]


def _running(spec: Carry, source: str, key: list[str], order: list[str], in_bins: bool) -> Column:
    partition = [*key, *([_BIN] if in_bins else []), *spec.by]
    seeds_first = [F.col(_IS_ROW).asc()] if in_bins else []
    window = (
        Window.partitionBy(*partition)
        .orderBy(*seeds_first, *_ordering(order, spec.ahead))
        .rowsBetween(Window.unboundedPreceding, -1 if spec.strict else Window.currentRow)
    )
    if spec.total:
        return F.coalesce(F.sum(source).over(window), F.lit(0).cast("bigint"))
    return F.last(source, ignorenulls=True).over(window)


def _bin_value(spec: Carry, source: str, order: list[str]) -> Column:
    """What the bins after this one (before it, looking ahead) learn from it."""
    if spec.total:
        return F.sum(source)
    position = F.when(F.col(source).isNotNull(), F.struct(*order))
    return (F.min_by if spec.ahead else F.max_by)(F.col(source), position)


def _seeds(binned: DataFrame, specs: dict[str, Carry], group: list[str], order: list[str],
           bits: int, levels: int) -> DataFrame:
    """What each (group, bin) starts with: one row per bin where that is not nothing."""
    per_bin = (
        binned.groupBy(*group, _BIN)
        .agg(*[_bin_value(spec, source, order).alias(source) for source, spec in specs.items()])
        .withColumnRenamed(_BIN, "__at")
    )
    from_other_bins = [
        Carry(f"{source}_start", F.col(source), ahead=spec.ahead, strict=True, total=spec.total)
        for source, spec in specs.items()
    ]
    carried = carry(per_bin, group, ["__at"], from_other_bins, bits, levels - 1)
    needed = [F.col(c.name) != 0 if c.total else F.col(c.name).isNotNull() for c in from_other_bins]
    return carried.where(reduce(Column.__or__, needed)).select(
        *group,
        F.col("__at").alias(_BIN),
        *[F.col(f"{source}_start").alias(source) for source in specs],
        F.lit(0).alias(_IS_ROW),
    )


def carry(df: DataFrame, key: list[str], order: list[str], values: list[Carry],
          bits: int = BIN_BITS, levels: int = 1) -> DataFrame:
    """Add one column per entry of ``values``.

    ``key`` are the group columns all values share and ``order`` the log order, whose
    first column is a BIGINT position. All values come out of one shuffle by (key, bin);
    narrower groups only sort again inside it. ``levels`` is how often the log is cut into
    bins: once, or again on the summaries of the level below.
    """
    # Windows of the widest group come first, so that the others need no shuffle.
    specs = {f"__value{i}": spec for i, spec in sorted(enumerate(values), key=lambda pair: len(pair[1].by))}
    with_values = df.withColumns({source: spec.value for source, spec in specs.items()})

    if levels == 0:
        together = with_values
    else:
        binned = with_values.withColumn(_BIN, F.shiftright(F.col(order[0]), bits))
        parts = [binned.withColumn(_IS_ROW, F.lit(1))]
        for by in dict.fromkeys(spec.by for spec in specs.values()):
            same_group = {source: spec for source, spec in specs.items() if spec.by == by}
            parts.append(_seeds(binned, same_group, [*key, *by], order, bits, levels))
        together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    for by in dict.fromkeys(spec.by for spec in specs.values()):
        together = together.withColumns(
            {
                spec.name: _running(spec, source, key, order, in_bins=levels > 0)
                for source, spec in specs.items()
                if spec.by == by
            }
        )
    if levels > 0:
        together = together.where(F.col(_IS_ROW) == 1).drop(_BIN, _IS_ROW)
    return together.drop(*specs)
