"""Sets of global transaction ids, ``server:1-5:9,server:3``.

A set is ``map<server, array<struct<lo, hi>>>``, its intervals sorted, apart and never
adjacent, so equal sets are equal values. Server ids are lower-cased; white space counts for
nothing. Texts that are no set, tagged ids among them, are null, a blank one is the empty set.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.binding import let

SET_TYPE = "map<string, array<struct<lo: bigint, hi: bigint>>>"
_INTERVALS = "array<struct<lo: bigint, hi: bigint>>"
_LEAST, _GREATEST = -(1 << 63), (1 << 63) - 1
_SERVER = "[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"
_NUMBER = "0*+[1-9][0-9]{0,17}+"
_PART = f"{_SERVER}(?::{_NUMBER}(?:-{_NUMBER})?+)++"


def _none() -> Column:
    return F.array().cast(_INTERVALS)


def _within(number: Column, intervals: Column) -> Column:
    return F.exists(intervals, lambda i: (i["lo"] <= number) & (number <= i["hi"]))


def runs(starts: Column, ends: Column) -> Column:
    """Intervals of two arrays of as many bounds, in any order."""
    return F.zip_with(
        F.sort_array(starts), F.sort_array(ends), lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))
    )


def _sorted_bounds(intervals: Column) -> Column:
    """All starts and all ends, each sorted on its own."""
    return F.struct(F.sort_array(_bounds(intervals, "lo")).alias("lo"), F.sort_array(_bounds(intervals, "hi")).alias("hi"))


def _bounds(intervals: Column, field: str) -> Column:
    return F.transform(intervals, lambda i: i[field])


def merged(intervals: Column) -> Column:
    """Intervals that may overlap → sorted, joined ones. With starts and ends sorted each on its
    own, a run ends at an end that lies apart from the start after it."""
    return let(_sorted_bounds(intervals), lambda b: runs(
        F.filter(b["lo"], lambda x, i: F.coalesce(x > F.get(b["hi"], i - 1) + 1, F.lit(True))),
        F.filter(b["hi"], lambda x, i: F.coalesce(F.get(b["lo"], i + 1) > x + 1, F.lit(True))),
    ))


def joined(intervals: Column) -> Column:
    """The same in linear time for intervals that do not overlap."""
    return let(intervals, lambda iv: let(
        F.struct(_bounds(iv, "lo").alias("lo"), F.transform(iv, lambda i: i["hi"] + 1).alias("next")),
        lambda b: runs(F.array_except(b["lo"], b["next"]),
                       F.transform(F.array_except(b["next"], b["lo"]), lambda x: x - 1)),
    ))


def numbers_to_runs(numbers: Column) -> Column:
    """Distinct numbers, in any order → their intervals."""
    return joined(F.transform(numbers, lambda n: F.struct(n.alias("lo"), n.alias("hi"))))


def gtid_parts(text: Column) -> Column:
    """One id ``server:number`` as a struct of both, null if it is none."""
    plain = F.lower(F.trim(text))
    return F.when(
        plain.rlike(f"^{_SERVER}:{_NUMBER}$"),
        F.struct(F.split_part(plain, F.lit(":"), F.lit(1)).alias("server"),
                 F.split_part(plain, F.lit(":"), F.lit(2)).cast("bigint").alias("number")),
    )


def _interval(text: Column) -> Column:
    bounds = F.split(text, "-")
    return F.struct(F.get(bounds, F.lit(0)).cast("bigint").alias("lo"),
                    F.element_at(bounds, -1).cast("bigint").alias("hi"))


def gtid_set(text: Column) -> Column:
    """Text → set. Servers may come more than once and intervals in any order and overlap;
    an interval that ends before it starts is empty."""
    def part(element: Column) -> Column:
        pieces = F.split(element, ":")
        return F.struct(
            F.get(pieces, F.lit(0)).alias("server"),
            F.filter(F.transform(F.slice(pieces, 2, F.size(pieces) - 1), _interval), lambda i: i["lo"] <= i["hi"]).alias("iv"),
        )

    def whole(plain: Column) -> Column:
        parts = F.transform(F.filter(F.split(plain, ","), lambda e: e != ""), part)
        return F.when(plain.rlike(f"^(?:{_PART})?+(?:,(?:{_PART})?+)*+$"), _of_parts(parts))

    return let(F.lower(F.regexp_replace(text, r"\s+", "")), whole)


def _of_parts(parts: Column) -> Column:
    """Set of an array of (server, intervals)."""
    def collected(ps: Column) -> Column:
        servers = F.array_sort(F.array_distinct(F.transform(ps, lambda p: p["server"])))
        return F.map_from_arrays(servers, F.transform(
            servers, lambda s: merged(F.flatten(F.transform(F.filter(ps, lambda p: p["server"] == s), lambda p: p["iv"])))
        ))

    return _without_empty(let(parts, collected)).cast(SET_TYPE)


def _without_empty(gtids: Column) -> Column:
    return F.map_filter(gtids, lambda _, iv: F.size(iv) > 0)


def gtid_text(gtids: Column) -> Column:
    """Set → text, servers in order."""
    def one(server: Column) -> Column:
        bounds = F.transform(gtids[server], lambda i: F.when(i["lo"] == i["hi"], i["lo"].cast("string")).otherwise(
            F.concat_ws("-", i["lo"].cast("string"), i["hi"].cast("string"))))
        return F.concat_ws(":", server, F.concat_ws(":", bounds))

    return F.when(gtids.isNotNull(), F.array_join(F.transform(F.array_sort(F.map_keys(gtids)), one), ","))


def _entries(gtids: Column) -> Column:
    return F.transform(F.map_entries(gtids), lambda e: F.struct(e["key"].alias("server"), e["value"].alias("iv")))


def gtid_union(a: Column, b: Column) -> Column:
    """Ids of either set; null if one is null."""
    return F.when(a.isNotNull() & b.isNotNull(), _of_parts(F.concat(_entries(a), _entries(b))))


def _gaps(intervals: Column) -> Column:
    """What lies before, between and after the intervals of a set."""
    starts = F.concat(F.array(F.lit(_LEAST)), F.transform(intervals, lambda i: i["hi"] + 1))
    ends = F.concat(F.transform(intervals, lambda i: i["lo"] - 1), F.array(F.lit(_GREATEST)))
    return F.zip_with(starts, ends, lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi")))


def _common(a: Column, b: Column) -> Column:
    """Numbers in the intervals of both, each without overlaps. As no number is in three of them,
    a common run goes from each start that is not after the end one place before."""
    return let(_sorted_bounds(F.concat(a, b)), lambda s: F.filter(
        F.transform(s["lo"], lambda x, i: F.struct(x.alias("lo"), F.get(s["hi"], i - 1).alias("hi"))),
        lambda r: r["lo"] <= r["hi"],
    ))


def gtid_subtract(a: Column, b: Column) -> Column:
    """Ids of ``a`` that are not in ``b``; null if one is null."""
    def rest(server: Column, iv: Column) -> Column:
        return _common(iv, _gaps(F.coalesce(F.try_element_at(b, server), _none())))

    return F.when(a.isNotNull() & b.isNotNull(), _without_empty(F.transform_values(a, rest)))


def gtid_has(gtids: Column, parts: Column) -> Column:
    """Whether a set holds an id (see ``gtid_parts``); null if either is null."""
    found = F.coalesce(F.try_element_at(gtids, parts["server"]), _none())
    return F.when(gtids.isNotNull() & parts.isNotNull(), _within(parts["number"], found))


def gtid_subset(a: Column, b: Column) -> Column:
    """Whether all ids of ``a`` are in ``b``; null if one is null."""
    return F.size(F.map_keys(gtid_subtract(a, b))) == 0
