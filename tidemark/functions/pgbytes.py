"""Reading fields out of Postgres logical-replication message bytes.

All expressions take a BINARY column and 1-based byte positions. Text is never
validated by ``decode`` (which raises on bad bytes); bad UTF-8 is replaced instead.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.binding import let
from tidemark.schema import TOAST_SENTINEL

# Microseconds between 1970-01-01 and 2000-01-01.
PG_EPOCH_MICROS = 946_684_800_000_000

# Column kinds of a tuple: text, null, unchanged out-of-line value.
_TEXT_KIND, _NULL_KIND, _TOAST_KIND = b"t", b"n", b"u"


def _int(pos) -> Column:
    return pos if isinstance(pos, Column) else F.lit(pos)


def uint(payload: Column, pos, size: int) -> Column:
    """Unsigned big-endian integer of ``size`` bytes."""
    return F.conv(F.hex(F.substring(payload, _int(pos), F.lit(size))), 16, 10).cast("bigint")


def int64(payload: Column, pos) -> Column:
    """Signed big-endian 64-bit integer."""
    return F.conv(F.hex(F.substring(payload, _int(pos), F.lit(8))), 16, -10).cast("bigint")


def char(payload: Column, pos) -> Column:
    """One byte as a character."""
    return F.substring(payload, _int(pos), F.lit(1)).cast("string")


def text(raw: Column) -> Column:
    return F.make_valid_utf8(raw.cast("string"))


def pg_timestamp(micros: Column) -> Column:
    """Microseconds since 2000-01-01 → timestamp."""
    return F.timestamp_micros(micros + F.lit(PG_EPOCH_MICROS))


def pg_tuple(payload: Column, start) -> Column:
    """Column values of the tuple at ``start``.

    Returns ``struct(pos, ok, values)``: the byte after the tuple, whether every
    column kind was known and inside the message, and the values as text (null for
    ``n``, a sentinel for an unchanged out-of-line value).
    """
    start = _int(start)
    end = F.octet_length(payload) + 1
    count = F.coalesce(uint(payload, start, 2).cast("int"), F.lit(0))

    def step(acc: Column, _: Column) -> Column:
        # An unknown kind makes the position null, and it stays null.
        pos = acc["pos"]

        def advance(c: Column) -> Column:
            is_text = c["kind"] == F.lit(_TEXT_KIND)
            # A length beyond the message stops just outside it.
            after_text = F.least(pos + F.lit(5) + c["length"], (end + 1).cast("bigint")).cast("int")
            value = F.when(is_text, F.substring(payload, pos + 5, c["length"].cast("int")).cast("string")).when(
                c["kind"] == F.lit(_TOAST_KIND), F.lit(TOAST_SENTINEL)
            )
            return F.struct(
                F.when(is_text, after_text)
                .when((c["kind"] == F.lit(_NULL_KIND)) | (c["kind"] == F.lit(_TOAST_KIND)), pos + 1)
                .alias("pos"),
                F.array_append(acc["values"], value).alias("values"),
            )

        kind = F.substring(payload, pos, F.lit(1))
        column = F.struct(
            kind.alias("kind"), F.least(uint(payload, pos + 1, 4), F.lit(2147483647)).alias("length")
        )
        return let(column, advance)

    columns = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    first = F.struct((start + 2).cast("int").alias("pos"), F.array().cast("array<string>").alias("values"))

    def checked(t: Column) -> Column:
        # One check for all values; a separator keeps their bytes apart.
        clean = F.is_valid_utf8(F.array_join(t["values"], " "))
        values = F.when(clean, t["values"]).otherwise(F.transform(t["values"], F.make_valid_utf8))
        whole = (t["pos"] <= end) & (start + 1 < end)
        return F.struct(t["pos"].alias("pos"), F.coalesce(whole, F.lit(False)).alias("ok"), values.alias("values"))

    return let(F.aggregate(columns, first, step), checked)


def relation_definition(payload: Column) -> Column:
    """``struct(schema, table, names)`` of a relation message; ``names`` is null unless the
    message holds as many columns as it declares.

    Bytes are viewed as Latin-1 so that one character is one byte, which lets the
    zero-terminated strings be split with ordinary string functions.
    """
    latin = F.decode(payload, "ISO-8859-1")
    zero = F.lit("\x00")
    body = F.substring(latin, F.lit(6), F.length(latin))

    def utf8(piece: Column) -> Column:
        return text(F.encode(piece, "ISO-8859-1"))

    schema = F.substring_index(body, "\x00", 1)
    rest = F.substring(body, F.length(schema) + 2, F.length(body))
    table = F.substring_index(rest, "\x00", 1)
    # After the table: replica identity (1), column count (2), then per column a flag
    # (1), the name, a zero, type id (4) and modifier (4).
    columns = F.substring(rest, F.length(table) + 5, F.length(rest))
    names = F.regexp_extract_all(columns, F.lit(r"(?s)\G.([^\x00]*+)\x00.{8}"), F.lit(1))
    declared = uint(payload, F.length(schema) + F.length(table) + 9, 2)
    return F.when(
        F.locate("\x00", body) > 0,
        F.struct(
            utf8(schema).alias("schema"),
            utf8(table).alias("table"),
            F.when(F.size(names) == declared, F.transform(names, utf8)).alias("names"),
        ),
    )
