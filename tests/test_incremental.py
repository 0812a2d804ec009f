"""Raw logs cut anywhere into batches give the events of the whole log."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.transactions import commit_gate
from tidemark.plans import fixtures
from tidemark.plans.normalise import normalise, publishable
from tidemark.sources.catalogs import column_dictionary
from tidemark.sources.logs import LANDED_SCHEMAS, stream_change_log
from tidemark.streaming.incremental import publish_raw, publish_redo

from test_transactions import log_frame, random_log

SF = "/root/testdata/sf0.001"
COLUMNS = ["connector", "table", "tx", "op", "ord", "ordinal", "commit_ord", "offset"]


def land(raw, path, cuts):
    edges = [-1, *cuts, 1 << 60]
    for lo, hi in zip(edges, edges[1:]):
        raw.where((F.col("ord") > lo) & (F.col("ord") <= hi)).coalesce(1).write.mode("append").parquet(path)


def as_set(frame, columns=COLUMNS):
    rows = [tuple(r) for r in frame.select(*columns).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("kind", ["postgres", "mysql"])
def test_cut_log_equals_whole(spark, tmp_path, kind):
    settings = {}
    if kind == "mysql":
        raw = fixtures.binlog(spark, SF)
        settings["dictionary"] = column_dictionary(fixtures.column_catalog(spark, SF))
    else:
        raw = fixtures.pg_log(spark, SF)
    landed = str(tmp_path / "in")
    land(raw, landed, [1234, 1236, 3000])
    out = str(tmp_path / "out")
    # A second start with the same checkpoint finds nothing to do.
    for _ in range(2):
        stream = stream_change_log(spark, landed, kind, max_files=1)
        publish_raw(stream, kind, out, str(tmp_path / "cp"), **settings).awaitTermination()
    committed, waiting, dead = publishable(normalise(kind, raw, **settings))
    assert as_set(spark.read.parquet(f"{out}/events")) == as_set(committed)
    reported = spark.read.parquet(f"{out}/dead_letters")
    columns = ["connector", "ord", "reason"]
    assert as_set(reported, columns) <= as_set(dead, columns)
    # What is not reported yet belongs to a transaction that is still open.
    assert dead.count() - reported.count() <= 8


def test_every_row_is_accounted_for(spark, tmp_path):
    """Abandoned transactions and rows that arrive late have outputs of their own."""
    held_back = F.col("ord").between(2000, 2100)
    whole = fixtures.pg_log(spark, SF)
    raw = whole.where(~held_back)
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(raw, landed, [1234, 3000, 9000])
    whole.where(held_back).coalesce(1).write.mode("append").parquet(landed)
    stream = stream_change_log(spark, landed, "postgres", max_files=1)
    publish_raw(stream, "postgres", out, str(tmp_path / "cp")).awaitTermination()
    places = ["connector", "ord"]
    committed, waiting, dead = publishable(normalise("postgres", raw))
    pending = as_set(spark.read.parquet(f"{out}/pending/batch=4"), places)
    abandoned = as_set(spark.read.parquet(f"{out}/abandoned"), places)
    reported = as_set(spark.read.parquet(f"{out}/dead_letters"), places)
    assert as_set(spark.read.parquet(f"{out}/events")) == as_set(committed)
    assert abandoned and abandoned == as_set(waiting, places) - pending
    assert reported and reported == as_set(dead, places) - pending
    assert as_set(spark.read.parquet(f"{out}/late"), places) == as_set(whole.where(held_back), places)


def test_decoded_log(spark, tmp_path):
    log = log_frame(spark, random_log(6))
    land(log, str(tmp_path / "in"), [100, 101, 350])
    stream = stream_change_log(spark, str(tmp_path / "in"), "log", max_files=1)
    publish_raw(stream, "log", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert as_set(spark.read.parquet(str(tmp_path / "out" / "events"))) == as_set(commit_gate(log))


def test_redo_stream(spark, tmp_path):
    """Positions read again, within a batch and across two, and a piece that comes late."""
    redo = fixtures.redo_log(spark, SF).select(*[c.split()[0] for c in LANDED_SCHEMAS["oracle"].split(", ")])
    mid = [r["scn"] for r in redo.where("scn % 4 = 0").orderBy("scn").collect()][300]
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    pieces = [redo.where(F.col("scn") <= mid), redo.where(F.col("scn") >= mid).union(redo.where(F.col("scn") % 6 == 0).where(F.col("scn") > mid)), redo.where(F.col("scn") < 200)]
    for part in pieces:
        part.coalesce(1).write.mode("append").parquet(landed)
        stream = stream_change_log(spark, landed, "oracle", max_files=1)
        publish_redo(stream, out, str(tmp_path / "cp"), "fin", 10, "orclpdb1").awaitTermination()
    batch = normalise("oracle", redo, owner="fin", start=10, container="orclpdb1")
    committed, _, dead = publishable(batch)
    columns = ["ord", "op", "tx", "database"]
    events = spark.read.parquet(f"{out}/events")
    assert as_set(events, columns) == as_set(committed, columns) and events.count() == committed.count()
    letters = spark.read.parquet(f"{out}/dead_letters")
    assert as_set(letters, ["ord"]) == as_set(dead, ["ord"]) and letters.count() == dead.count()
    late = spark.read.schema(LANDED_SCHEMAS["oracle"]).parquet(f"{out}/late")
    assert as_set(late, ["ord"]) == as_set(redo.where("scn >= 10 and scn < 200 and src_con_name = 'ORCLPDB1'"), ["ord"])
