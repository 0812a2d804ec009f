r"""Reading the SQL text of mined redo records.

A statement is accepted only when one pattern matches all of it; the same building
blocks then pull out columns and values. Anything else yields null, and the caller
falls back to carrying the raw text. The quantifiers over literals are possessive, so
a literal of any length is matched in constant stack.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from tidemark.functions.binding import let
from tidemark.functions.images import last_wins

# Building blocks of the patterns.
_TEXT = r"'[^']*+(?:''[^']*+)*+'"
_IDENT = r'(?:"[^"]*+"|[A-Za-z_][A-Za-z0-9_$#]*+)'
_NAME = rf"{_IDENT}(?:\s*+\.\s*+{_IDENT})*+"
_ARGS0 = rf"(?:[^'()]++|{_TEXT})*+"
_ARGS1 = rf"(?:[^'()]++|{_TEXT}|\({_ARGS0}\))*+"
_ARGS2 = rf"(?:[^'()]++|{_TEXT}|\({_ARGS1}\))*+"
_CALL = rf"[A-Za-z_][A-Za-z0-9_$#.]*+\s*+\({_ARGS2}\)"
_TYPED = rf"(?:DATE|TIMESTAMP|N)\s*+{_TEXT}"
_NUMBER = r"[+-]?+(?:\d++(?:\.\d*+)?+|\.\d++)(?:[eE][+-]?+\d++)?+"
_ITEM = rf"(?:{_TEXT}|{_TYPED}|{_CALL}|{_NUMBER}|NULL)"
_VALUE = rf"{_ITEM}(?:\s*+\|\|\s*+{_ITEM})*+"

_ASSIGN = rf"{_NAME}\s*+=\s*+{_VALUE}"
_OTHER_TERM = rf"{_NAME}\s*+(?:IS\s++(?:NOT\s++)?+NULL|(?:<>|!=|<=|>=|<|>)\s*+{_VALUE})"
_TERM = rf"(?:{_ASSIGN}|{_OTHER_TERM})"
_AND_LIST = rf"{_TERM}(?:\s++AND\s++{_TERM})*+"
_ANY_LIST = rf"{_TERM}(?:\s++(?:AND|OR)\s++{_TERM})*+"
_ASSIGN_LIST = rf"{_ASSIGN}(?:\s*+,\s*+{_ASSIGN})*+"
_IDENT_LIST = rf"{_IDENT}(?:\s*+,\s*+{_IDENT})*+"
_VALUE_LIST = rf"{_VALUE}(?:\s*+,\s*+{_VALUE})*+"

# Group 1 is what the parts are taken from and is never empty when the statement matches.
INSERT = rf"(?i)^\s*+INSERT\s++INTO\s++{_NAME}\s*+\(\s*+({_IDENT_LIST}\s*+\)\s*+VALUES\s*+\(\s*+{_VALUE_LIST})\s*+\)\s*+;?+\s*+$"
def _update(condition: str) -> str:
    return rf"(?i)^\s*+UPDATE\s++{_NAME}\s++(?:(?!SET\s){_IDENT}\s++)?+SET\s++({_ASSIGN_LIST}(?:\s++WHERE\s++{condition})?+)\s*+;?+\s*+$"


def _delete(condition: str) -> str:
    return rf"(?i)^\s*+DELETE\s++FROM\s++({_NAME}(?:\s++(?!WHERE\s){_IDENT})?+(?:\s++WHERE\s++{condition})?+)\s*+;?+\s*+$"


UPDATE, UPDATE_ANY = _update(_AND_LIST), _update(_ANY_LIST)
DELETE, DELETE_ANY = _delete(_AND_LIST), _delete(_ANY_LIST)

_INSERT_HEAD = rf"(?i)^{_IDENT_LIST}\s*+\)\s*+VALUES\s*+\(\s*+"
_UPDATE_HEAD = rf"(?i)^{_ASSIGN_LIST}(?:\s++WHERE\s++)?+"
_DELETE_HEAD = rf"(?i)^{_NAME}(?:\s++(?!WHERE\s){_IDENT})?+(?:\s++WHERE\s++)?+"

_EACH_IDENT = rf"\G\s*+,?+\s*+({_IDENT})"
_EACH_VALUE = rf"(?i)\G\s*+,?+\s*+({_VALUE})"
_EACH_ASSIGN = rf"(?i)\G\s*+,?+\s*+({_NAME})\s*+=\s*+({_VALUE})"
_EACH_TERM = rf"(?i)\G\s*+(?:AND\s++)?+({_NAME})\s*+(?:=\s*+({_VALUE})|(IS\s++NULL)|IS\s++NOT\s++NULL|(?:<>|!=|<=|>=|<|>)\s*+{_VALUE})"
_WHOLE_TEXT = rf"^{_TEXT}$"

# Calls may be nested to any depth; the patterns follow this many parentheses, and deeper
# ones are exchanged for characters that text does not have.
_DEPTH = 3
_OPEN, _CLOSE = "﷐", "﷑"
_MANY = rf"\((?:[^(]*+\(){{{_DEPTH}}}"
# Balanced, and nested no deeper than that.
_FLAT = r"""(?:'[^']*+'|"[^"]*+"|[^'"()]++)"""
_NESTED = rf"{_FLAT}*+"
for _ in range(_DEPTH):
    _NESTED = rf"(?:{_FLAT}|\({_NESTED}\))*+"
_TAME = rf"^{_NESTED}\z"
_TOKEN = r"""'[^']*+'|"[^"]*+"|[()]|[^'"()]++|['"]"""
_OUTSIDE = r"(?=(?:[^']*+'[^']*+')*+[^']*+$)"


def _name(raw: Column, upper: bool) -> Column:
    bare = F.replace(raw, F.lit('"'), F.lit(""))
    return F.upper(bare) if upper else bare


def clean_value(raw: Column, literal_parity: bool) -> Column:
    """SQL literal → text. With ``literal_parity`` only the outer quotes go; otherwise
    NULL becomes null and doubled quotes become single ones."""
    restored = F.regexp_replace(F.regexp_replace(raw, _OPEN + _OUTSIDE, "("), _CLOSE + _OUTSIDE, ")")
    raw = F.when(raw.contains(_OPEN), restored).otherwise(raw)
    if literal_parity:
        return F.regexp_replace(raw, "^'|'$", "")
    inner = F.replace(F.substring(raw, F.lit(2), F.length(raw) - 2), F.lit("''"), F.lit("'"))
    is_text = F.startswith(raw, F.lit("'")) & raw.rlike(_WHOLE_TEXT)
    return F.when(is_text, inner).when(F.upper(raw) == "NULL", F.lit(None)).otherwise(raw)


def _parts(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _image(names: Column, values: Column, upper: bool, literal_parity: bool) -> Column:
    return last_wins(
        F.transform(names, lambda n: _name(n, upper)),
        F.transform(values, lambda v: clean_value(v, literal_parity)),
    )


def _may_be_deep(sql: Column) -> Column:
    return sql.rlike(_MANY) & ~sql.rlike(_TAME)


def _shallow(sql: Column) -> Column:
    """The statement with parentheses nested deeper than the patterns follow exchanged for
    marks, outside of literals. ``clean_value`` takes the marks back. Going through the tokens
    is slow, so only statements do that one pattern does not show to be shallow."""

    def step(acc: Column, token: Column) -> Column:
        opens, closes = token == "(", token == ")"
        depth = acc["depth"] + F.when(opens, 1).otherwise(0)
        marked = F.when(depth > _DEPTH, F.when(opens, F.lit(_OPEN)).when(closes, F.lit(_CLOSE)).otherwise(token)).otherwise(token)
        return F.struct(
            (depth - F.when(closes, 1).otherwise(0)).alias("depth"), F.concat(acc["text"], marked).alias("text")
        )

    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"))
    return F.when(_may_be_deep(sql), F.aggregate(_parts(sql, _TOKEN, 0), start, step)["text"]).otherwise(sql)


def _body(sql: Column, pattern: str) -> Column:
    return F.regexp_extract(_shallow(F.coalesce(sql, F.lit(""))), pattern, 1)


def _no_values() -> Column:
    return F.create_map().cast("map<string,string>")


def parse_insert(sql: Column, literal_parity: bool = False) -> Column:
    """INSERT text → after image, or null when it is not understood."""

    def read(body: Column) -> Column:
        lists = F.struct(
            _parts(body, _EACH_IDENT).alias("names"),
            _parts(F.regexp_replace(body, _INSERT_HEAD, ""), _EACH_VALUE).alias("values"),
        )
        return let(
            lists,
            lambda x: F.when(
                F.size(x["names"]) == F.size(x["values"]),
                _image(x["names"], x["values"], not literal_parity, literal_parity),
            ),
        )

    return let(_body(sql, INSERT), lambda body: F.when(body != "", read(body)))


def _where(condition: Column, literal_parity: bool) -> Column:
    """Equalities joined by AND → before image; other comparisons carry no value."""

    def read(text: Column) -> Column:
        terms = F.arrays_zip(
            _parts(text, _EACH_TERM, 1).alias("name"),
            _parts(text, _EACH_TERM, 2).alias("value"),
            _parts(text, _EACH_TERM, 3).alias("null_test"),
        )
        # A group that took no part in the match is an empty text.
        return F.filter(
            terms,
            lambda t: t["value"] != "" if literal_parity else (t["value"] != "") | (t["null_test"] != ""),
        )

    return let(
        let(condition, read),
        lambda x: last_wins(
            F.transform(x, lambda t: _name(t["name"], upper=True)),
            F.transform(x, lambda t: F.when(t["value"] != "", clean_value(t["value"], literal_parity))),
        ),
    )


def parse_update(sql: Column, literal_parity: bool = False) -> Column:
    """UPDATE text → ``struct(before, assigned)`` or null. ``assigned`` holds every SET
    column; use ``delta`` to drop the unchanged ones. Under an OR no old value is certain,
    so ``before`` is empty."""

    def read(body: Column, before: Column) -> Column:
        assigned = _image(
            _parts(body, _EACH_ASSIGN, 1), _parts(body, _EACH_ASSIGN, 2), True, literal_parity
        )
        return F.struct(before.alias("before"), assigned.alias("assigned"))

    def values(body: Column) -> Column:
        return read(body, _where(F.regexp_replace(body, _UPDATE_HEAD, ""), literal_parity))

    return let(
        _body(sql, UPDATE),
        lambda body: F.when(body != "", values(body)).otherwise(
            let(_body(sql, UPDATE_ANY), lambda other: F.when(other != "", read(other, _no_values())))
        ),
    )


def parse_delete(sql: Column, literal_parity: bool = False) -> Column:
    """DELETE text → before image, or null when it is not understood."""
    return let(
        _body(sql, DELETE),
        lambda body: F.when(
            body != "", _where(F.regexp_replace(body, _DELETE_HEAD, ""), literal_parity)
        ).when(_body(sql, DELETE_ANY) != "", _no_values()),
    )


def raw_image(sql: Column) -> Column:
    """Fallback image that carries the statement itself."""
    return F.create_map(F.lit("raw_sql"), sql)


# One token of a statement: group 1 is kept (quoted and plain identifiers); of what is
# masked, group 2 is the quote of a text, which may lack its end.
_MASKED_TOKEN = (
    r"[Nn]?(')[^']*+(?:''[^']*+)*+(?:'|\z)"
    r"""|("[^"]*+(?:"|\z)|[\p{L}_$#][\p{L}\p{N}_$#]*+)"""
    r"|--[^\r\n]*+|/\*(?:(?!\*/)[\s\S])*+(?:\*/|\z)"
    r"|0[xX][0-9A-Fa-f]++|(?:\p{N}++(?:\.\p{N}*+)?+|\.\p{N}++)(?:[eE][+-]?+\p{N}++)?+[dDfF]?+(?![\p{L}\p{N}_$#])|\p{N}++"
)
_MARK = "\u0001"


def obfuscate_sql(sql: Column) -> Column:
    """Mask what a statement says about its rows: texts (national ones and dates included)
    become ``'?'``, numbers and comments ``?``. Names stay, whatever digits they hold.

    All tokens are found in one pass, so a quote in a comment or in a quoted name opens no
    text. A text without an end goes on to the end of the statement. Signs stay."""
    marked = F.regexp_replace(F.translate(sql, _MARK, " "), _MASKED_TOKEN, "$2" + _MARK + "$1")
    # A mark right after a name stands for the name itself.
    kept = F.regexp_replace(marked, r"""([\p{L}\p{N}_$#"])""" + _MARK, "$1")
    texts = F.regexp_replace(kept, _MARK + "'", "'?'")
    return F.translate(texts, _MARK, "?")
