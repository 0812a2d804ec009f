"""Event ids, offset maps and event JSON."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def event_id(connector, offset, ord, ordinal) -> Column:
    """md5 of the log position in 8-4-4-4-12 form."""
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit(""))
             for c in (connector, offset, ord, ordinal)]
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def offset_map(connector_type: Column, offset: Column) -> Column:
    """One-entry coordinate map; the key depends on the kind of source."""
    key = (
        F.when(connector_type == "postgres", F.lit("lsn"))
        .when(connector_type == "mysql", F.lit("binlog_pos"))
        .otherwise(F.lit("scn"))
    )
    return F.when(offset.isNotNull(), F.create_map(key, offset))


def iso_instant(ts: Column) -> Column:
    """ISO-8601 UTC text with no, three or six fraction digits, whichever is exact."""
    # Counted from the epoch without a zone, so the session's zone and its gaps don't matter.
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    seconds = F.timestamp_add("SECOND", F.floor(F.unix_micros(ts) / 1_000_000).cast("long"), epoch).cast("string")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    fraction = (
        F.when(micros == 0, F.lit(""))
        .when(micros % 1000 == 0, F.concat(F.lit("."), F.lpad((micros / 1000).cast("int").cast("string"), 3, "0")))
        .otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    )
    return F.concat(F.translate(seconds, " ", "T"), fraction, F.lit("Z"))


def event_json() -> Column:
    """The event columns of ``to_event`` as JSON text; null fields are written out."""
    return F.to_json(
        F.struct(
            "eventId",
            "operation",
            iso_instant(F.col("timestamp")).alias("timestamp"),
            "source",
            "before",
            "after",
        ),
        {"ignoreNullFields": "false"},
    )
