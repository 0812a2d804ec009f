"""What is built on the published log: state, history, types and changed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.images import cast_failures, delta, typed_columns
from tidemark.operators.ordered import BIN_BITS, Carry, carry
from tidemark.schema import TOAST_SENTINEL

# Order of changes in the lake: commit order, then arrival inside the transaction. Positions
# compare within one connector only, so the keys below must hold the connector if there are
# several.
CHANGE_ORDER = ["commit_ord", "ord", "ordinal"]


def dedup_events(events: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per event id. Copies of an event are equal, so any one will do; they are
    reduced before the shuffle."""
    return events.dropDuplicates([key])


def typed(events: DataFrame, fields: dict[str, str], image: str = "after",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """Text image → typed columns. Text that does not fit becomes null and is counted in
    ``cast_failures``."""
    return events.select(
        *keep,
        *typed_columns(F.col(image), fields),
        cast_failures(F.col(image), fields).alias("cast_failures"),
    )


def latest_change(committed: DataFrame, pk: list[str]) -> DataFrame:
    """The last change of each key, deletes included. Kept as an aggregate: a key that
    holds a third of all rows is reduced to one row per task before the shuffle."""
    latest = committed.groupBy(*pk).agg(
        F.max_by(F.struct(*[c for c in committed.columns if c not in pk]), F.struct(*CHANGE_ORDER)).alias("row")
    )
    return latest.select(*pk, "row.*")


def current_state(committed: DataFrame, pk: list[str]) -> DataFrame:
    """The current row of each key; deleted keys are left out."""
    return latest_change(committed, pk).where(F.col("op") != "DELETE")


def history(committed: DataFrame, pk: list[str], bits: int = BIN_BITS) -> DataFrame:
    """Add ``valid_from`` and ``valid_to`` (null for the last): each change holds until
    the next change of its key. The time used is that of the commit.

    A key with very many changes is cut into bins of commit positions; only its changes
    inside a single transaction stay together.
    """
    stamped = committed.withColumn("valid_from", F.coalesce("commit_ts", "ts"))
    following = Carry("valid_to", F.col("valid_from"), ahead=True, strict=True)
    return carry(stamped, pk, CHANGE_ORDER, [following], bits)


def changed_columns(events: DataFrame) -> DataFrame:
    """How often each column of each table really changed in an update."""
    updates = events.where((F.col("op") == "UPDATE") & F.col("before").isNotNull())
    names = updates.select(
        "connector", "schema", "table",
        F.explode(F.map_keys(delta(F.col("before"), F.col("after")))).alias("column"),
    )
    return names.groupBy("connector", "schema", "table", "column").agg(F.count("*").alias("changes"))


def _known(image: str, column: str) -> Column:
    value = F.try_element_at(F.col(image), F.lit(column))
    return F.when(value != TOAST_SENTINEL, value)


def fill_toast(rows: DataFrame, pk: list[str], columns: list[str], order: list[str] | None = None,
               bits: int = BIN_BITS) -> DataFrame:
    """Replace the sentinel of unchanged out-of-line values in ``after``.

    For each of ``columns`` (those that can be stored out of line) the value is taken from
    ``before``, else from the last change of the same key that knew it. Without either the
    sentinel stays.
    """
    order = order or CHANGE_ORDER
    # A known null is a value too, so what is carried is a struct around it.
    carries = []
    for i, name in enumerate(columns):
        after_knows = F.map_contains_key(F.col("after"), F.lit(name)) & ~F.try_element_at(
            F.col("after"), F.lit(name)
        ).eqNullSafe(TOAST_SENTINEL)
        before_knows = F.map_contains_key(F.col("before"), F.lit(name)) & ~F.try_element_at(
            F.col("before"), F.lit(name)
        ).eqNullSafe(TOAST_SENTINEL)
        value = F.when(after_knows, F.struct(_known("after", name).alias("v"))).when(
            before_knows, F.struct(_known("before", name).alias("v"))
        )
        carries.append(Carry(f"__known{i}", value))
    known = carry(rows, pk, order, carries, bits)

    def replaced(image: Column, name: str, replacement: Column) -> Column:
        return F.transform_values(
            image,
            lambda k, v: F.when(
                (k == name) & v.eqNullSafe(TOAST_SENTINEL) & replacement.isNotNull(), replacement["v"]
            ).otherwise(v),
        )

    filled = F.col("after")
    for i, name in enumerate(columns):
        filled = replaced(filled, name, F.col(f"__known{i}"))
    return known.withColumn("after", filled).drop(*[f"__known{i}" for i in range(len(columns))])
