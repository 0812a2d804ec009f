"""Naming an intermediate value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are costly to compute and used more than once afterwards.

    They are unpacked from a one-element array: filters and projections are not merged
    through a generator, so no later step can repeat the computation.
    """
    packed = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(packed)))
