"""Redo text: values of every form, fallbacks, and a reader written the slow way."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.images import delta
from tidemark.functions import redo
from tidemark.functions.redo import obfuscate_sql, parse_delete, parse_insert, parse_update
from tidemark.operators.oracle import redo_events


def one(spark, expression, sql):
    return spark.createDataFrame([(sql,)], "sql STRING").select(expression.alias("x")).first()["x"]


def insert(spark, sql, **kw):
    return one(spark, parse_insert(F.col("sql"), **kw), sql)


def update(spark, sql, **kw):
    return one(spark, parse_update(F.col("sql"), **kw), sql)


def delete(spark, sql, **kw):
    return one(spark, parse_delete(F.col("sql"), **kw), sql)


def test_insert_values(spark):
    sql = (
        """insert into "S"."T"("ID","Name",PLAIN,"D","N","F","C","X") values ('1','it''s (a, b)',-12.5e3,"""
        """TO_DATE('01-JAN-24', 'DD-MON-RR'),NULL,EMPTY_CLOB(),'a' || 'b',TO_TIMESTAMP(f('x, )')));"""
    )
    assert insert(spark, sql) == {
        "ID": "1", "NAME": "it's (a, b)", "PLAIN": "-12.5e3", "D": "TO_DATE('01-JAN-24', 'DD-MON-RR')",
        "N": None, "F": "EMPTY_CLOB()", "C": "'a' || 'b'", "X": "TO_TIMESTAMP(f('x, )'))",
    }


def test_literal_text(spark):
    sql = """insert into "T"("a","B") values ('it''s',NULL)"""
    assert insert(spark, sql, literal_parity=True) == {"a": "it''s", "B": "NULL"}


@pytest.mark.parametrize(
    "sql",
    [
        "garbage", "", "insert into T(A,B) values ('1')", "insert into T(A) values ('1'", "insert into T(A) values ('1') x",
        "insert into T(A) values ('1''')'')", "insert into T(A) values (1 2)", "delete from T where A = '1'", None,
    ],
)
def test_insert_not_understood(spark, sql):
    assert insert(spark, sql) is None


def test_update_all_set_columns(spark):
    sql = (
        """update "RH"."F" set "CARGO" = 'Analista', "DEP" = 'TI', "OLD" = NULL where "ID" = '158' and "CARGO" = 'Estagiário'"""
        """ and "DEP" = 'TI' and "GONE" IS NULL and "Z" IS NOT NULL and "V" > 5 and ROWID = 'AAAx+/A';"""
    )
    found = update(spark, sql)
    assert found["before"] == {"ID": "158", "CARGO": "Estagiário", "DEP": "TI", "GONE": None, "ROWID": "AAAx+/A"}
    assert found["assigned"] == {"CARGO": "Analista", "DEP": "TI", "OLD": None}


def test_update_forms(spark):
    assert update(spark, "update T set A = '1'")["before"] == {}
    assert update(spark, "update T t set A = '1' where B = '2' or C = '3'")["before"] == {}
    assert update(spark, "UPDATE T SET A='1' WHERE B='and C = 4 where'")["before"] == {"B": "and C = 4 where"}
    assert update(spark, "update T set where A = '1'") is None
    assert update(spark, "update T set A = '1' where (B = '2')") is None


def test_delete_forms(spark):
    assert delete(spark, "delete from T") == {}
    assert delete(spark, """delete from "T" where "A" = '1' and B IS NULL;""") == {"A": "1", "B": None}
    assert delete(spark, """delete from "T" where "A" = '1' and B IS NULL""", literal_parity=True) == {"A": "1"}
    assert delete(spark, "delete from T where A like '1'") is None


def test_long_literal(spark):
    """A literal of any length is read whole, also one full of doubled quotes."""
    text = ("x" * 50 + "''") * 20_000
    found = insert(spark, f"insert into T(A,B) values ('{text}','end')")
    assert found["A"] == text.replace("''", "'")
    assert found["B"] == "end"


def test_random_statements(spark):
    """Generated statements come back as they were put in."""
    rng = random.Random(7)
    alphabet = ["'", "''", " and ", "=", ",", "(", ")", "x", "É", "\n", " where ", '"', ";", "NULL"]

    def value():
        return rng.choice([None, "".join(rng.choice(alphabet) for _ in range(rng.randrange(8)))])

    def quote(v):
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'"

    cases = []
    for i in range(300):
        old = {f"C{j}": value() for j in range(rng.randrange(1, 6))}
        new = {c: value() for c in rng.sample(sorted(old), rng.randrange(1, len(old) + 1))}
        sets = ", ".join(f'"{c}" = {quote(v)}' for c, v in new.items())
        where = " and ".join(f'"{c}" IS NULL' if v is None else f'"{c}" = {quote(v)}' for c, v in old.items())
        cases.append((i, f'update "S"."T" set {sets} where {where};', old, new))
    frame = spark.createDataFrame([(i, sql) for i, sql, _, _ in cases], "i INT, sql STRING")
    parsed = frame.select("i", parse_update(F.col("sql")).alias("u"))
    found = {r["i"]: r for r in parsed.select("i", "u.*", delta("u.before", "u.assigned").alias("d")).collect()}
    for i, sql, old, new in cases:
        assert found[i]["before"] == old, sql
        assert found[i]["assigned"] == new, sql
        assert found[i]["d"] == {c: v for c, v in new.items() if old[c] is None or old[c] != v}, sql


def marked_slowly(sql):
    """Marks for parentheses nested deeper than three, character by character."""
    out, depth, i = [], 0, 0
    while i < len(sql):
        c = sql[i]
        end = sql.find(c, i + 1) if c in "'\"" else -1
        depth += c == "("
        deep = depth > 3 and c in "()"
        out.append({"(": redo._OPEN, ")": redo._CLOSE}[c] if deep else sql[i:max(i, end) + 1])
        depth -= c == ")"
        i = max(i, end) + 1
    return "".join(out)


def test_only_deep_statements_are_walked(spark):
    """Four opening parentheses anywhere, in texts too, had the tokens of a statement gone through."""
    shallow = ["insert into T(A,B) values (TO_DATE('1', 'Y'),'it''s, (b)')", "f(a(b(c)))(d)(e(f(')')))", "x" * 5 + "(a)" * 50000,
               """"(" = '((((' and b = ")" """, "(((())" + "'", None, ""]
    rng = random.Random(5)
    mixed = ["".join(rng.choice(["(", "(", ")", ")", "'", '"', "a", " b\n"]) for _ in range(rng.randint(4, 24))) for _ in range(3000)]
    cases = shallow + mixed + ["f(" * 4 + "x" + ")" * 4, "f(" * 3 + "'('" + ")" * 3 + "((a))"]
    sql = F.col("sql")
    rows = spark.createDataFrame([(s,) for s in cases], "sql STRING").select(
        "sql", redo._shallow(sql).alias("marked"), redo._may_be_deep(sql).alias("walked")).collect()
    assert [r["marked"] for r in rows] == [s if s is None else marked_slowly(s) for s in cases]
    assert not any(r["walked"] for r in rows[:4])
    assert any(r["marked"] != r["sql"] for r in rows[7:]) and all(r["walked"] for r in rows if r["marked"] != r["sql"])


def test_fallback_rows(spark):
    rows = [
        ("c", 1, 1, "junk ' text", "INSERT", "T", "O", None, None), ("c", 2, 2, "junk", "UPDATE", "T", "O", None, "x"),
        ("c", 3, 3, "junk", "DELETE", "T", "O", None, None), ("c", 4, 4, " ", "DELETE", "T", "O", None, None),
        ("c", 5, 5, None, "INSERT", "T", "O", None, None), ("c", 6, 6, "drop table x", "DDL", "T", "O", None, None),
    ]
    frame = spark.createDataFrame(
        rows,
        "connector STRING, ord BIGINT, scn BIGINT, sql_redo STRING, operation STRING, table_name STRING, seg_owner STRING, "
        "src_con_name STRING, tx_name STRING",
    ).withColumns({"timestamp": F.lit(None).cast("timestamp"), "ingested_at": F.current_timestamp()})
    found = {r["ord"]: r for r in redo_events(frame).collect()}
    assert sorted(found) == [1, 2, 3]
    assert found[1]["after"] == {"raw_sql": "junk ' text"} and found[1]["before"] is None
    assert found[2]["after"] == {"raw_sql": "junk"} and found[2]["before"] == {} and found[2]["tx"] == "x"
    assert found[3]["before"] == {"raw_sql": "junk"} and found[3]["tx"] == "ora-tx-3"
    assert all(r["reason"] for r in found.values())


def test_obfuscate(spark):
    mask = lambda sql: one(spark, obfuscate_sql(F.col("sql")), sql)
    assert mask("set A = 'it''s', B = '' where C = 'x'") == "set A = '?', B = '?' where C = '?'"
    assert mask("set A = 'open and secret") == "set A = '?'"
    assert mask("set A = 'x' and B = 'open 'secret") == "set A = '?' and B = '?'secret"
    assert mask("no literals") == "no literals"


def test_obfuscate_numbers_and_comments(spark):
    mask = lambda sql: one(spark, obfuscate_sql(F.col("sql")), sql)
    assert mask("insert into T(CPF,SAL) values (12345678901, -9500.50, 1e-7, .5, 0x1F)") == (
        "insert into T(CPF,SAL) values (?, -?, ?, ?, ?)")
    assert mask("""update "S 1"."T2" set C3 = 7, "4" = N'x' where ROWID = 'AA1'""") == (
        """update "S 1"."T2" set C3 = ?, "4" = '?' where ROWID = '?'""")
    assert mask("set D = DATE '2024-01-02', E=to_date('1','2')") == "set D = DATE '?', E=to_date('?','?')"
    assert mask("a = 1 -- it's 5\nand b = 2 /* c = '3 */ and d = 4") == "a = ? ?\nand b = ? ? and d = ?"
    assert mask("""x = "it's" and y = 'secret'""") == """x = "it's" and y = '?'"""
    assert mask("a1'b2'3c") == "a1'?'?c"
    assert mask("x = 1\u00012 and y = /* open 3") == "x = ? ? and y = ?"
    assert mask("") == "" and mask(None) is None
    assert mask("a in (" + ",".join(str(n) for n in range(50000)) + ")") == "a in (" + ",".join(["?"] * 50000) + ")"
    assert mask("a = '" + "x''" * 200000 + "'") == "a = '?'"
