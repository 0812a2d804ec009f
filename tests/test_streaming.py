"""Streams fed in several batches give what the batch operators give."""

import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics, positions
from tidemark.operators import transactions as tx
from tidemark.sources.logs import stream_change_log
from tidemark.schema import LOG_SCHEMA
from tidemark.streaming import gate, sinks

from test_transactions import START, log_frame, random_log


def land(log, path, cuts):
    """Write the log in pieces, one after the other, in log order."""
    edges = [-1, *cuts, 1 << 60]
    for lo, hi in zip(edges, edges[1:]):
        log.where((F.col("ord") > lo) & (F.col("ord") <= hi)).coalesce(1).write.mode("append").parquet(path)


def run(stream, mode="append"):
    name = f"q_{uuid.uuid4().hex}"
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def simple_log(spark, n=120):
    """Two connectors, interleaved transactions of six rows, every third left open."""
    rows, ord_ = [], 0
    for t in range(0, n, 2):
        for i in range(6):
            for k in (t, t + 1):
                rows.append(("ab"[k % 2], f"t{k}", "INSERT", ord_))
                ord_ += 1
        for k in (t, t + 1):
            if k % 3:
                rows.append(("ab"[k % 2], f"t{k}", "COMMIT", ord_))
                ord_ += 1
    return log_frame(spark, rows)


def gated(spark, pieces, path, **settings):
    """Committed, waiting and late rows after the pieces came one by one."""
    for piece in pieces:
        piece.coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = stream_change_log(spark, f"{path}/in", "log", max_files=1)
        gate.publish_committed(stream, f"{path}/out", f"{path}/cp", **settings).awaitTermination()
    every = {k: v for k, v in settings.items() if k == "compact_every"}
    read = spark.read.schema(LOG_SCHEMA)
    return spark.read.parquet(f"{path}/out/committed"), gate.read_waiting(spark, f"{path}/out", **every), read.parquet(f"{path}/out/late")


def places(rows, *columns):
    return sorted(map(tuple, rows.select("connector", "ord", *columns).collect()))


@pytest.mark.parametrize("settings", [{}, {"compact_every": 2}])
def test_gate_stream_equals_batch(spark, tmp_path, settings):
    """Ids come back after their commit; one transaction holds much of the log."""
    log = log_frame(spark, random_log(8))
    edges = [0, 90, 91, 300, 450, 600]
    pieces = [log.where((F.col("ord") >= lo) & (F.col("ord") < hi)) for lo, hi in zip(edges, edges[1:])]
    committed, waiting, late = gated(spark, pieces, str(tmp_path), **settings)
    assert places(committed, "commit_ord", "commit_offset") == places(tx.commit_gate(log), "commit_ord", "commit_offset")
    assert places(waiting) == places(tx.uncommitted(log)) and late.isEmpty()


@pytest.mark.parametrize("settings", [{}, {"compact_every": 1}])
def test_gate_stream_loses_no_late_row(spark, tmp_path, settings):
    """Rows hours behind, with their commit or long after it, are published all the same."""
    def piece(*rows):
        return log_frame(spark, [("a", tx_id, op, ord_) for tx_id, op, ord_ in rows])

    pieces = [
        piece(("t0", "INSERT", 1), ("t0", "COMMIT", 2)), piece(("t1", "INSERT", 18000), ("t1", "COMMIT", 18001), ("t9", "INSERT", 18002)),
        piece(("t2", "INSERT", 1200), ("t2", "COMMIT", 1201), ("t0", "UPDATE", 0)), piece(("t9", "DELETE", 90000)),
        piece(("t9", "COMMIT", 200000), ("t9", "INSERT", 200001)),
    ]
    committed, waiting, late = gated(spark, pieces, str(tmp_path), **settings)
    assert places(committed, "commit_ord") == [("a", 0, 2), ("a", 1, 2), ("a", 1200, 1201), ("a", 18000, 18001), ("a", 18002, 200000), ("a", 90000, 200000)]
    assert places(waiting) == [("a", 200001)] and late.isEmpty()


def test_rows_before_forgotten_commits_are_late(spark, tmp_path):
    log = log_frame(spark, random_log(9))
    pieces = [log.where((F.col("ord") >= lo) & (F.col("ord") < lo + 100)) for lo in range(0, 600, 100)]
    pieces = [*pieces[:1], *pieces[2:], pieces[1]]
    outcomes = gated(spark, pieces, str(tmp_path), compact_every=2, remember=1)
    found = sorted(p for rows in outcomes for p in places(rows))
    assert found == places(log.where(tx.is_data())) and not outcomes[2].isEmpty()


def test_gate_writes_only_what_a_batch_adds(spark, tmp_path):
    """A long open transaction is not written again by later batches."""
    first = log_frame(spark, [("a", "long", "INSERT", i) for i in range(500)])
    rest = [log_frame(spark, [("a", f"t{i}", "INSERT", 1000 + 2 * i), ("a", f"t{i}", "COMMIT", 1001 + 2 * i)]) for i in range(3)]
    _, waiting, _ = gated(spark, [first, *rest], str(tmp_path))
    out = str(tmp_path / "out")
    assert [spark.read.schema(LOG_SCHEMA).parquet(f"{out}/open/batch={b}").count() for b in range(4)] == [500, 0, 0, 0]
    assert waiting.count() == 500


@pytest.mark.parametrize("salted", [True, False])
def test_dedup_stream(spark, tmp_path, salted):
    log = log_frame(spark, [("a", "1", "INSERT", i) for i in range(60)])
    for _ in range(3):
        land(log.where("ord < 40"), str(tmp_path), [20])
    land(log, str(tmp_path), [])
    stream = stream_change_log(spark, str(tmp_path), "log", max_files=2)
    out = run(gate.dedup_stream(stream, ["connector", "ord"], within="1 hour", salted=salted))
    assert sorted(r["ord"] for r in out.collect()) == list(range(60))


def test_counts_stream(spark, tmp_path):
    log = simple_log(spark)
    land(log, str(tmp_path), [100, 200])
    stream = stream_change_log(spark, str(tmp_path), "log", max_files=1)
    out = run(metrics.events_processed(stream, window="10 seconds", lateness="5 seconds"), "complete")
    found = {r["connector"]: r["n"] for r in out.groupBy("connector").agg(F.sum("events").alias("n")).collect()}
    assert found == {r["connector"]: r["events"] for r in metrics.events_processed(log).collect()}


def test_late_rows_are_dropped(spark, tmp_path):
    log = log_frame(spark, [("a", "1", "INSERT", i) for i in (0, 1, 5000, 7000, 9000)])
    late = log_frame(spark, [("a", "1", "INSERT", 2)])
    # A batch is checked against the watermark that held when the batch before it began.
    for part in (log.where("ord < 10"), log.where("ord = 5000"), log.where("ord = 7000"), late, log.where("ord = 9000")):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path))
    stream = stream_change_log(spark, str(tmp_path), "log", max_files=1)
    out = run(metrics.windowed_activity(stream, "1 minute", lateness="1 minute"))
    assert [r["events"] for r in out.where(F.col("window_start") == F.timestamp_seconds(F.lit(START - START % 60))).collect()] == [2]


def test_publish_batches(spark, tmp_path):
    """Several outputs per batch; restarting with the same checkpoint adds nothing."""
    committed = tx.commit_gate(log_frame(spark, random_log(4))).withColumn("pk", F.col("ord") % 20)
    for part in (committed.where("ord < 300"), committed.where("ord >= 300")):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    out = str(tmp_path / "out")
    for _ in range(2):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        sinks.publish_batches(stream, out, str(tmp_path / "cp"), ["pk"], dead=F.col("op") == "READ").awaitTermination()
    events = spark.read.parquet(f"{out}/events")
    assert events.count() == committed.where("op <> 'READ'").count()
    assert {r["topic"] for r in events.select("topic").distinct().collect()} <= {f"cdc.{c}.public.{t}" for c in "ab" for t in "tu"}
    assert spark.read.parquet(f"{out}/dead_letters").count() == committed.where("op = 'READ'").count()
    saved = {r["connector"]: r["offset"] for r in sinks.read_offsets(spark, out).collect()}
    batch = {r["connector"]: r["offset"] for r in positions.latest_offsets(committed).collect()}
    assert set(saved) == set(batch)
    assert sinks.read_offsets(spark, str(tmp_path / "none")).count() == 0


def test_scratch_dir(spark, tmp_path):
    spark.conf.set("spark.checkpoint.dir", str(tmp_path)) if spark.conf.isModifiable("spark.checkpoint.dir") else None
    assert sinks.scratch_dir(spark, "x")
