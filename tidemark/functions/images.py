"""Row images: maps from column name to text value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.binding import let


def row_image(df: DataFrame, columns: list[str] | None = None) -> Column:
    """All columns of a typed row as text, in table order."""
    names = columns or df.columns
    return F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]),
        F.array(*[F.col(n).cast("string") for n in names]),
    )


def last_wins(keys: Column, values: Column) -> Column:
    """Map from two arrays in which a repeated key keeps its last value."""

    def dedup(pairs: Column) -> Column:
        names, total = pairs["keys"], F.size(pairs["keys"])
        zipped = F.arrays_zip(names.alias("key"), pairs["values"].alias("value"))
        last = F.filter(
            zipped,
            lambda p, i: ~F.array_contains(F.slice(names, i + 2, F.greatest(total - i - 1, F.lit(0))), p["key"]),
        )
        return F.when(
            F.size(F.array_distinct(names)) == total, F.map_from_arrays(names, pairs["values"])
        ).otherwise(F.map_from_entries(F.transform(last, lambda p: F.struct(p["key"], p["value"]))))

    return let(F.struct(keys.alias("keys"), values.alias("values")), dedup)


def name_columns(values: Column, names: Column, prefix: str = "col_") -> Column:
    """Positional values → named map. Positions beyond the known names are kept under
    ``prefix`` + index; with fewer values than names the rest are absent."""

    def named(pair: Column) -> Column:
        known, row = pair["names"], pair["values"]
        size = F.size(known)
        # Nearly always there is a distinct name for each value.
        simple = (F.size(row) == size) & (F.size(F.array_distinct(known)) == size)
        keys = F.transform(
            row, lambda _, i: F.coalesce(F.get(known, i), F.concat(F.lit(prefix), i.cast("string")))
        )
        return F.when(row.isNotNull(), F.when(simple, F.map_from_arrays(known, row)).otherwise(last_wins(keys, row)))

    known = F.coalesce(names, F.array().cast("array<string>"))
    return let(F.struct(known.alias("names"), values.alias("values")), named)


def delta(before: Column, after: Column) -> Column:
    """Entries of ``after`` whose before value is null, absent or different."""
    old = F.coalesce(before, F.create_map().cast("map<string,string>"))
    return F.map_filter(
        after,
        lambda k, v: F.try_element_at(old, k).isNull() | ~F.try_element_at(old, k).eqNullSafe(v),
    )


def full_after(before: Column, after: Column) -> Column:
    """Full new row from the old row and the changed columns."""
    kept = F.map_filter(before, lambda k, _: ~F.map_contains_key(after, k))
    return F.when(before.isNull(), after).when(after.isNull(), F.lit(None)).otherwise(F.map_concat(after, kept))


def typed_columns(image: Column, fields: dict[str, str]) -> list[Column]:
    """One ``try_cast`` column per field of ``{name: spark type}``."""
    return [F.try_element_at(image, F.lit(n)).try_cast(t).alias(n) for n, t in fields.items()]


def cast_failures(image: Column, fields: dict[str, str]) -> Column:
    """How many of the fields hold text that does not fit its type."""
    total = F.lit(0)
    for name, dtype in fields.items():
        text = F.try_element_at(image, F.lit(name))
        total = total + (text.isNotNull() & text.try_cast(dtype).isNull()).cast("int")
    return total
