"""Commit gate, order, cap and summary; one transaction may hold most of the rows."""

import random

from pyspark.sql import functions as F

from tidemark.operators import lake, metrics, positions
from tidemark.operators import transactions as tx
from tidemark.schema import LOG_SCHEMA


START = 1_000_000


def log_frame(spark, rows):
    """Rows of (connector, tx, op, ord[, table[, ordinal]]); one second per position."""
    records = []
    for connector, tx_id, op, ord_, *rest in rows:
        table = rest[0] if rest else "t"
        ordinal = rest[1] if len(rest) > 1 else 0
        schema = "system" if op in ("BEGIN", "COMMIT") else "public"
        records.append((connector, tx_id, op, ord_, table, ordinal, schema))
    small = spark.createDataFrame(
        records, "connector STRING, tx STRING, op STRING, ord BIGINT, `table` STRING, ordinal INT, `schema` STRING"
    ).withColumns(
        {
            "ts": F.timestamp_seconds(F.col("ord") + START), "ingested_at": F.timestamp_seconds(F.col("ord") + START + 1),
            "offset": F.col("ord").cast("string"), "connector_type": F.lit("oracle"), "database": F.lit("d"),
            "before": F.lit(None).cast("map<string,string>"),
            "after": F.create_map(F.lit("v"), F.col("ord").cast("string")),
        }
    )
    return small.select(*[F.col(f.name).cast(f.dataType) for f in LOG_SCHEMA])


def buffered(rows):
    """Reads the log one record at a time, as a buffer per transaction would."""
    pending, out = {}, []
    for connector, tx_id, op, ord_, *_ in sorted(rows, key=lambda r: r[3]):
        key = connector, tx_id
        if op == "COMMIT":
            out += [(connector, o, ord_, i + 1) for i, o in enumerate(pending.pop(key, []))]
        elif op != "BEGIN":
            pending.setdefault(key, []).append(ord_)
    return sorted(out), sorted((c, o) for (c, _), rows_ in pending.items() for o in rows_)


def random_log(seed, n=600):
    rng = random.Random(seed)
    rows = []
    for ord_ in range(n):
        connector = rng.choice("aab")
        tx_id = "hot" if rng.random() < 0.4 else f"t{rng.randrange(12)}"
        op = "COMMIT" if rng.random() < (0.01 if tx_id == "hot" else 0.1) else rng.choice(["INSERT", "UPDATE", "DELETE", "READ", "BEGIN"])
        rows.append((connector, tx_id, op, ord_, rng.choice(["t", "u"])))
    return rows


def test_gate_equals_buffer(spark):
    """Ids come back after their commit, one transaction holds much of the log."""
    for seed, bits in ((1, 2), (2, 4), (3, 18)):
        rows = random_log(seed)
        committed, waiting = buffered(rows)
        log = log_frame(spark, rows)
        found = tx.emit_order(log, bits).select("connector", "ord", "commit_ord", "tx_seq").collect()
        assert sorted(tuple(r) for r in found) == committed
        still = tx.uncommitted(log, bits).select("connector", "ord").collect()
        assert sorted(tuple(r) for r in still) == waiting


def test_cap_keeps_the_surplus(spark):
    rows = [("a", "x", "INSERT", i) for i in range(25)] + [("a", "x", "COMMIT", 25)]
    kept, surplus = tx.cap_transaction(tx.attribute_commits(log_frame(spark, rows)), 10, bits=2)
    assert [r["ord"] for r in kept.orderBy("ord").collect()] == list(range(10))
    assert [r["ord"] for r in surplus.orderBy("ord").collect()] == list(range(10, 25))


def test_summary_and_empty_commit(spark):
    log = log_frame(
        spark,
        [("a", "1", "INSERT", 1, "t"), ("a", "1", "INSERT", 2, "u"), ("a", "1", "COMMIT", 3), ("a", "2", "COMMIT", 9)],
    )
    summary = tx.tx_summary(log).collect()
    assert [(r["tx"], r["n_rows"], r["tables"], r["first_ord"], r["last_ord"]) for r in summary] == [
        ("1", 2, ["public.t", "public.u"], 1, 2)
    ]
    # The commit without rows saves no position.
    assert positions.latest_offsets(tx.commit_gate(log)).first()["offset"] == "3"


def test_control_counts(spark):
    log = log_frame(spark, [("a", "1", "INSERT", 1), ("a", "1", "COMMIT", 2)])
    framed = log.withColumn("schema", F.lit("public"))
    assert metrics.events_processed(framed).agg(F.sum("events")).first()[0] == 1
    assert metrics.events_processed(framed, include_control=True).agg(F.sum("events")).first()[0] == 2


def test_state_and_history(spark):
    rows = [
        ("a", "1", "INSERT", 1), ("a", "1", "UPDATE", 2), ("a", "1", "COMMIT", 3),
        ("a", "2", "DELETE", 4), ("a", "2", "COMMIT", 6), ("a", "3", "INSERT", 5), ("a", "3", "COMMIT", 7),
    ]
    gated = tx.commit_gate(log_frame(spark, rows)).withColumn("pk", F.lit(1))
    state = lake.current_state(gated, ["pk"]).collect()
    # The delete was written before the insert was, and committed before it.
    assert [(r["op"], r["ord"]) for r in state] == [("INSERT", 5)]
    spans = lake.history(gated, ["pk"], bits=1).orderBy("commit_ord", "ord").collect()
    seconds = lambda t: None if t is None else int(t.timestamp()) - START
    assert [(r["ord"], seconds(r["valid_from"]), seconds(r["valid_to"])) for r in spans] == [
        (1, 3, 3), (2, 3, 6), (4, 6, 7), (5, 7, None)
    ]


def test_nothing_is_lost(spark):
    rows = random_log(9)
    log = log_frame(spark, rows)
    data = log.where(tx.is_data()).count()
    assert tx.commit_gate(log, 3).count() + tx.uncommitted(log, 3).count() == data


def test_toast(spark):
    hidden = "__TOASTED_VALUE__"
    rows = [(1, 1, None, {"v": "a"}), (1, 2, None, {"v": hidden}), (1, 3, {"v": "b"}, {"v": hidden}), (1, 4, {"v": hidden}, {"v": hidden}),
            (1, 5, None, {"v": None}), (1, 6, None, {"v": hidden}), (2, 7, None, {"v": hidden}), (2, 8, None, None)]
    frame = spark.createDataFrame(rows, "pk INT, ord BIGINT, before MAP<STRING,STRING>, after MAP<STRING,STRING>")
    filled = lake.fill_toast(frame, ["pk"], ["v"], ["ord"], bits=1).orderBy("ord").collect()
    assert [r["after"] and r["after"]["v"] for r in filled] == ["a", "a", "b", "b", None, None, hidden, None]
