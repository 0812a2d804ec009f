"""Column expressions on texts shared by the operators. Words are runs of characters other
than the space and the controls from tab to carriage return."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def word_array(text: Column) -> Column:
    """Words of a text that is not null."""
    core = trimmed(text)
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, SPACE_RUN))


def count_words(text: Column) -> Column:
    return F.size(word_array(text))


def symbol_count(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, SPACES, "")).cast("long")
