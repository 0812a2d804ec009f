"""Sets of transaction ids against Python sets."""

import random
import time

from pyspark.sql import functions as F

from tidemark.functions import gtid as ids
from tidemark.operators.gtid import gtid_offsets, gtid_sets, resume_binlog
from tests.test_mysql import frame

A, B, C = (f"0{x}000000-0000-0000-0000-00000000000{x}" for x in "abc")


def text_of(members):
    """Canonical text of a set of (server, number)."""
    parts = []
    for server in sorted({s for s, _ in members}):
        numbers, runs = sorted(n for s, n in members if s == server), []
        for n in numbers:
            if runs and runs[-1][1] == n - 1:
                runs[-1][1] = n
            else:
                runs.append([n, n])
        parts.append(":".join([server, *(str(lo) if lo == hi else f"{lo}-{hi}" for lo, hi in runs)]))
    return ",".join(parts)


def members_of(intervals):
    return {(s, n) for s, lo, hi in intervals for n in range(lo, hi + 1)}


def untidy(intervals):
    return " ,\n".join(f"{s.upper()}:{lo}-{hi}" if lo != hi else f"{s}:{lo}" for s, lo, hi in intervals)


def random_set(rng, most):
    found = []
    for _ in range(rng.randrange(most)):
        lo = rng.randrange(1, 40)
        found.append((rng.choice((A, B, C)), lo, lo + rng.randrange(6)))
    return found


def test_algebra(spark):
    rng = random.Random(7)
    pairs = [(random_set(rng, 12), random_set(rng, 12)) for _ in range(300)]
    pairs += [(a, a[: len(a) // 2]) for a, _ in pairs[:50]]
    frame_ = spark.createDataFrame([(i, untidy(a), untidy(b)) for i, (a, b) in enumerate(pairs)], "i INT, a STRING, b STRING")
    sets = frame_.select("i", ids.gtid_set(F.col("a")).alias("a"), ids.gtid_set(F.col("b")).alias("b"))
    a, b = F.col("a"), F.col("b")
    found = sets.select(
        "i", ids.gtid_text(a).alias("text"), ids.gtid_text(ids.gtid_union(a, b)).alias("union"),
        ids.gtid_text(ids.gtid_subtract(a, b)).alias("minus"), ids.gtid_subset(b, a).alias("subset"),
        ids.gtid_has(a, ids.gtid_parts(F.lit(f"{A}:20"))).alias("has"),
    ).collect()
    for r in found:
        left, right = map(members_of, pairs[r["i"]])
        assert r["text"] == text_of(left)
        assert r["union"] == text_of(left | right)
        assert r["minus"] == text_of(left - right)
        assert r["subset"] == (right <= left)
        assert r["has"] == ((A, 20) in left)


def test_texts(spark):
    cases = {
        "": "", " ,, ": "", f"{A}:5-3": "", f"{A}:007-8": f"{A}:7-8", f"{A}:0": None, f"{A}": None, f"{A}:": None, "x:1": None,
        f"{A}:1-2-3": None, f"{A}:tag:1": None, "mysql-bin.000001:154": None, f"{A}:{'9' * 18}": f"{A}:{'9' * 18}",
        f"{A}:{'9' * 19}": None, None: None,
    }
    long = f"{A}:" + ":".join(str(n) for n in range(1, 6000, 2))
    texts = [*cases, long]
    rows = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING")
    found = {r["i"]: r["x"] for r in rows.select("i", ids.gtid_text(ids.gtid_set(F.col("t"))).alias("x")).collect()}
    assert [found[i] for i in range(len(texts))] == [*cases.values(), long]


def test_sets_of_rows(spark):
    rng = random.Random(3)
    members = {(A, n) for n in range(4000, 9000)} | {(B, rng.randrange(1, 30000)) for _ in range(3000)} | {(B, 1 << 50)}
    rows = [("m", f"{s}:{n}") for s, n in members] * 2 + [("m", "junk"), ("m", None), ("n", None)]
    found = gtid_sets(spark.createDataFrame(rows, "c STRING, gtid STRING").repartition(5), ["c"])
    assert [(r["c"], r["t"]) for r in found.select("c", ids.gtid_text(F.col("gtids")).alias("t")).collect()] == [("m", text_of(members))]


def test_resume(spark):
    log = frame(spark, [
        (1, "TABLE_MAP", {}), (2, "WRITE", {"gtid": f"{A}:1"}), (3, "XID", {"gtid": f"{A}:1"}),
        (4, "WRITE", {"gtid": f"{B}:1"}), (5, "XID", {"gtid": f"{B}:1"}),
        (6, "WRITE", {"gtid": f"{A.upper()}:2"}), (7, "XID", {"gtid": "?"}), (8, "XID", {"gtid": f"{A}:3"}),
    ])

    def left(*offsets):
        stored = spark.createDataFrame([("m", o) for o in offsets], "connector STRING, offset STRING")
        rows = resume_binlog(log, stored)
        assert rows.columns == log.columns
        return sorted(r["ord"] for r in rows.collect())

    everything = list(range(1, 9))
    assert left() == left(" ") == left("junk") == left(None) == everything
    assert left(f"{A}:1-2") == [1, 4, 5, 7, 8]
    assert left(f"{A}:1", f"{A}:1-2,{B}:1", "f.000001:80") == [1, 7, 8]
    assert left("f.000001:30", "f.000001:50") == [5, 6, 7, 8]
    assert [r["offset"] for r in gtid_offsets(log).collect()] == [f"{A}:1:3,{B}:1"]
    assert gtid_offsets(log.limit(0)).count() == 0


def test_resumed_rows_keep_their_transactions(spark):
    """Numbers of commits shift when reading starts later; ids do not."""
    from tests.test_mysql import MAP, names
    from tidemark.operators.mysql import binlog_events

    entries = []
    for n in range(1, 7):
        own = {"gtid": f"{A}:{n}"}
        entries += [(n * 10, "TABLE_MAP", MAP), (n * 10 + 1, "WRITE", {"table_id": 1, "rows": [(None, [str(n), "v"])], **own}), (n * 10 + 2, "XID", own)]
    log = frame(spark, entries)
    stored = spark.createDataFrame([("m", f"{A}:1-3:5")], "connector STRING, offset STRING")

    def rows(part):
        found = binlog_events(part, names(spark), mode="landed").where(F.col("op") == "INSERT")
        return {(r["ord"], r["tx"], r["commit_ord"]) for r in found.collect()}

    assert rows(resume_binlog(log, stored)) == {r for r in rows(log) if r[0] in (41, 61)}


MANY = 60_000


def many_gaps(spark):
    """Stored sets of odd numbers and of every third, as texts."""
    def text(step):
        numbers = F.sequence(F.lit(1), F.lit(MANY), F.lit(step)).cast("array<string>")
        return F.concat(F.lit(f"{A}:"), F.array_join(numbers, ":"))

    stored = spark.range(1).select(F.lit("m").alias("connector"), text(2).alias("odd"), text(3).alias("third"))
    return stored, set(range(1, MANY + 1, 2)), set(range(1, MANY + 1, 3))


def test_sets_of_many_intervals(spark):
    """These took time with the square of the number of intervals."""
    began = time.monotonic()
    stored, left, right = many_gaps(spark)
    sets = stored.select(ids.gtid_set("odd").alias("a"), ids.gtid_set("third").alias("b"))
    rest, union = ids.gtid_subtract(F.col("a"), F.col("b")), ids.gtid_union(F.col("a"), F.col("b"))
    row = sets.select(F.size(rest[A]).alias("rest"), F.transform(union[A], lambda i: i["hi"] - i["lo"] + 1).alias("union")).first()
    assert row["rest"] == len(left - right)
    assert sum(row["union"]) == len(left | right)
    assert time.monotonic() - began < 60


def test_resume_by_many_intervals(spark):
    """Every row searched the whole set."""
    began = time.monotonic()
    stored, left, right = many_gaps(spark)
    log = spark.range(1, MANY + 1).select(
        F.lit("m").alias("connector"), F.col("id").alias("ord"), F.lit("f.000001").alias("file"), (F.col("id") * 10).alias("pos"),
        F.concat(F.lit(f"{A}:"), F.col("id").cast("string")).alias("gtid"))
    offsets = stored.select("connector", F.explode(F.array("odd", "third")).alias("offset"))
    kept = {r["ord"] for r in resume_binlog(log, offsets).select("ord").collect()}
    assert kept == set(range(1, MANY + 1)) - left - right
    assert time.monotonic() - began < 60


def test_resume_keeps_repeats_and_rows_without_connector(spark):
    log = frame(spark, [(1, "WRITE", {"gtid": f"{A}:1"}), (2, "WRITE", {"gtid": f"{A}:4"}), (3, "WRITE", {"gtid": "?"})])
    log = log.union(log).union(log.withColumn("connector", F.lit(None).cast("string")))
    stored = spark.createDataFrame([("m", f"{A}:1-2"), ("m", f"{A}:2-3"), (None, f"{A}:1-9")], "connector STRING, offset STRING")
    found = sorted((r["connector"] or "", r["ord"]) for r in resume_binlog(log, stored).collect())
    assert found == [("", 1), ("", 2), ("", 3), ("m", 2), ("m", 2), ("m", 3), ("m", 3)]
