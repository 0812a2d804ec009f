"""Joins against side tables that are usually, but not provably, small."""

from __future__ import annotations

from pyspark.sql import DataFrame


def side_join(rows: DataFrame, side: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join ``rows`` to a side table that has few rows per key (``how``: inner, left,
    left_semi or left_anti).

    The strategy is left to adaptive execution, which knows the bytes of the side when it
    has been computed: a small side is broadcast, otherwise both sides are shuffled and
    partitions that a hot key fills are split.
    """
    if side.isStreaming:
        raise ValueError("the side table must be a batch table")
    return rows.join(side, on, how)
