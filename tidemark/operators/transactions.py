"""Transactions: which rows were committed, by which commit, and in what order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.ordered import BIN_BITS, Carry, carry
from tidemark.schema import DATA_OPERATIONS

TX = ["connector", "tx"]
ROW_ORDER = ["ord", "ordinal"]


def is_data():
    return F.col("op").isin(*DATA_OPERATIONS)


def attribute_commits(log: DataFrame, bits: int = BIN_BITS) -> DataFrame:
    """Data rows with the commit that closes them.

    Adds ``commit_ord``, ``commit_ts`` and ``commit_offset`` from the next COMMIT of the
    same transaction id at or after the row; null while the transaction is open. A
    transaction id used again later is therefore kept apart.
    """
    relevant = log.where(is_data() | (F.col("op") == "COMMIT"))
    commit = F.when(
        F.col("op") == "COMMIT",
        F.struct(F.col("ord").alias("ord"), F.col("ts").alias("ts"), F.col("offset").alias("offset")),
    )
    found = carry(relevant, TX, ROW_ORDER, [Carry("commit", commit, ahead=True)], bits)
    return (
        found.where(is_data())
        .withColumns(
            {
                "commit_ord": F.col("commit.ord"),
                "commit_ts": F.col("commit.ts"),
                "commit_offset": F.col("commit.offset"),
            }
        )
        .drop("commit")
    )


def commit_gate(log: DataFrame, bits: int = BIN_BITS) -> DataFrame:
    """Rows of committed transactions only."""
    return attribute_commits(log, bits).where(F.col("commit_ord").isNotNull())


def uncommitted(log: DataFrame, bits: int = BIN_BITS) -> DataFrame:
    """Rows whose transaction has not been committed (yet)."""
    open_rows = attribute_commits(log, bits).where(F.col("commit_ord").isNull())
    return open_rows.drop("commit_ord", "commit_ts", "commit_offset")


def tx_sequence(committed: DataFrame, bits: int = BIN_BITS) -> DataFrame:
    """Add ``tx_seq``: 1, 2, … in arrival order within each committed (or still open)
    transaction. Publishing order is (connector, commit_ord, tx_seq)."""
    return carry(
        committed,
        [*TX, "commit_ord"],
        ROW_ORDER,
        [Carry("tx_seq", F.lit(1).cast("bigint"), total=True)],
        bits,
    )


def emit_order(log: DataFrame, bits: int = BIN_BITS) -> DataFrame:
    """Committed rows with the columns that define publishing order."""
    return tx_sequence(commit_gate(log, bits), bits)


def cap_transaction(attributed: DataFrame, cap: int, bits: int = BIN_BITS) -> tuple[DataFrame, DataFrame]:
    """Split into the first ``cap`` rows of each transaction and the surplus.

    Only for reproducing a bounded buffer: nothing is dropped, the surplus is returned.
    """
    numbered = tx_sequence(attributed, bits)
    return numbered.where(F.col("tx_seq") <= cap), numbered.where(F.col("tx_seq") > cap)


def tx_summary(log: DataFrame, bits: int = BIN_BITS) -> DataFrame:
    """Size and extent of each committed transaction.

    Rows are first reduced per table, so the list of tables is collected from one row
    per table and not from the transaction's rows.
    """
    keys = [*TX, "commit_ord"]
    per_table = (
        commit_gate(log, bits)
        .groupBy(*keys, "schema", "table")
        .agg(F.count("*").alias("n"), F.min("ord").alias("lo"), F.max("ord").alias("hi"))
    )
    return per_table.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"),
        F.array_sort(F.collect_set(F.concat_ws(".", "schema", "table"))).alias("tables"),
        F.min("lo").alias("first_ord"),
        F.max("hi").alias("last_ord"),
    )
