"""Message bytes: tuples, relations, transactions and everything broken."""

import struct

from pyspark.sql import functions as F

from tidemark.functions.pgbytes import pg_timestamp, pg_tuple
from tidemark.operators.postgres import pg_events


def text(value):
    raw = value if isinstance(value, bytes) else value.encode()
    return b"t" + struct.pack(">I", len(raw)) + raw


def tup(*columns):
    return struct.pack(">h", len(columns)) + b"".join(columns)


def begin(xid, us=0):
    return b"B" + bytes(8) + struct.pack(">q", us) + struct.pack(">I", xid)


def commit(us=0):
    return b"C" + bytes(17) + struct.pack(">q", us)


def relation(rel, schema, table, *names):
    body = b"".join(b"\0" + n.encode() + b"\0" + bytes(8) for n in names)
    return b"R" + struct.pack(">I", rel) + schema.encode() + b"\0" + table.encode() + b"\0d" + struct.pack(">h", len(names)) + body


def insert(rel, *columns):
    return b"I" + struct.pack(">I", rel) + b"N" + tup(*columns)


def log(spark, messages, connector="c"):
    rows = [(connector, "db", i, f"0/{i:X}", bytearray(m)) for i, m in enumerate(messages)]
    frame = spark.createDataFrame(rows, "connector STRING, database STRING, ord BIGINT, offset STRING, payload BINARY")
    return frame.withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp"))


def decode(spark, messages, bits=2):
    return {r["ord"]: r for r in pg_events(log(spark, messages), bits).collect()}


def test_update_images(spark):
    key, full = tup(text("1"), b"n"), tup(text("1"), text("old"))
    new = tup(text("1"), b"u")
    u = lambda *parts: b"U" + struct.pack(">I", 7) + b"".join(parts)
    found = decode(
        spark,
        [
            begin(5), relation(7, "public", "t", "id", "v"), u(b"O", full, b"N", new), u(b"K", key, b"N", new),
            u(b"N", new), b"D" + struct.pack(">I", 7) + b"K" + key, commit(1_000_000),
        ],
    )
    toasted = {"id": "1", "v": "__TOASTED_VALUE__"}
    assert (found[2]["before"], found[2]["after"]) == ({"id": "1", "v": "old"}, toasted)
    assert (found[3]["before"], found[3]["after"]) == ({"id": "1", "v": None}, toasted)
    assert (found[4]["before"], found[4]["after"]) == (None, toasted)
    assert (found[5]["op"], found[5]["before"], found[5]["after"]) == ("DELETE", {"id": "1", "v": None}, None)
    assert {found[i]["tx"] for i in (0, 2, 3, 4, 5, 6)} == {"5"}
    assert found[2]["commit_ord"] == 6 and found[2]["commit_offset"] == "0/6"
    assert str(found[2]["ts"]) == "2000-01-01 00:00:01"


def test_relations_change_and_miss(spark):
    found = decode(
        spark,
        [
            begin(1), insert(7, text("1")), relation(7, "s", "a", "x"), insert(7, text("1"), text("2")),
            relation(7, "s", "b", "y"), insert(7, text("1")), insert(8, text("1")), commit(),
        ],
    )
    assert found[1]["reason"] == "relation unknown" and found[6]["reason"] == "relation unknown"
    assert (found[3]["table"], found[3]["after"]) == ("a", {"x": "1", "col_unknown_1": "2"})
    assert (found[5]["table"], found[5]["after"]) == ("b", {"y": "1"})


def test_transactions(spark):
    r = relation(7, "s", "a", "x")
    row = insert(7, text("1"))
    found = decode(spark, [r, row, begin(1), row, begin(2), row, commit(), row, begin(3), row])
    commits = {i: found[i]["commit_ord"] for i in (1, 3, 5, 7, 9)}
    assert commits == {1: None, 3: None, 5: 6, 7: None, 9: None}
    assert [found[i]["tx"] for i in (1, 3, 5, 7, 9)] == ["0", "1", "2", "0", "3"]
    assert found[6]["op"] == "COMMIT" and found[6]["tx"] == "2"


def test_large_xid_is_unsigned(spark):
    assert decode(spark, [begin(4_000_000_000)])[0]["tx"] == "4000000000"


def test_broken_messages(spark):
    r = relation(7, "s", "a", "x")
    long_length = b"I" + struct.pack(">I", 7) + b"N" + struct.pack(">h", 1) + b"t" + struct.pack(">I", 2**32 - 1) + b"ab"
    cut = insert(7, text("abc"))[:-1]
    bad_kind = insert(7, text("1"), b"z", text("2"))
    invalid = insert(7, text(b"a\xffb"))
    found = decode(spark, [r, long_length, cut, bad_kind, b"I\0\0", invalid, b"", b"Y123", insert(7)])
    assert [found[i]["reason"] for i in (1, 2, 3)] == ["tuple malformed"] * 3
    assert found[4]["reason"] == "relation unknown"
    assert found[5]["after"] == {"x": "a�b"} and found[5]["reason"] is None
    assert 6 not in found and 7 not in found
    assert found[8]["after"] == {}


def test_tuple_position(spark):
    payload = b"xx" + tup(text("é"), b"n", text(""), b"u") + b"rest"
    row = spark.createDataFrame([(bytearray(payload),)], "p BINARY").select(pg_tuple(F.col("p"), 3).alias("t")).first()["t"]
    assert row["values"] == ["é", None, "", "__TOASTED_VALUE__"] and row["ok"]
    assert row["pos"] == len(payload) - 3


def test_timestamp(spark):
    row = spark.range(1).select(F.unix_micros(pg_timestamp(F.lit(-1))).alias("a"), F.unix_micros(pg_timestamp(F.lit(7))).alias("b"))
    assert tuple(row.first()) == (946684800_000000 - 1, 946684800_000007)
