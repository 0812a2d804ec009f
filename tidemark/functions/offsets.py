"""Restart positions as text and as comparable values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

POSITION = "decimal(20,0)"


def offset_value(coordinates: Column) -> Column:
    """Offset text of a coordinate map: ``lsn``, else ``binlog_pos``, else whatever
    comes first, else empty."""
    return F.coalesce(
        F.try_element_at(coordinates, F.lit("lsn")),
        F.try_element_at(coordinates, F.lit("binlog_pos")),
        F.get(F.map_values(coordinates), F.lit(0)),
        F.lit(""),
    )


def offset_key(connector_type: Column, offset: Column) -> Column:
    """Comparable ``struct(file, position)`` of an offset text, null when malformed.

    Postgres ``hi/lo`` hex pairs become one number, MySQL ``file:position`` compares
    the numeric file suffix first, anything else is a plain number.
    """
    text = F.trim(offset)

    def hex_part(index: int) -> Column:
        return F.conv(F.split_part(text, F.lit("/"), F.lit(index)), 16, 10).cast(POSITION)

    lsn = F.when(
        text.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"),
        (hex_part(1) * F.lit(4294967296).cast(POSITION) + hex_part(2)).cast(POSITION),
    )
    binlog_file = F.regexp_extract(text, r"^.*?(\d{1,18}):(\d{1,20})$", 1).try_cast("bigint")
    binlog_pos = F.regexp_extract(text, r"^.*?(\d{1,18}):(\d{1,20})$", 2).try_cast(POSITION)
    scn = text.try_cast(POSITION)

    def key(file: Column, position: Column) -> Column:
        return F.when(position.isNotNull(), F.struct(file.alias("file"), position.alias("position")))

    no_file = F.lit(0).cast("bigint")
    return (
        F.when(connector_type == "postgres", key(no_file, lsn))
        .when(connector_type == "mysql", key(binlog_file, binlog_pos))
        .otherwise(key(no_file, scn))
    )
