"""Configs, snapshots, offsets, joins, messages and JSON."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.offsets import offset_key, offset_value
from tidemark.functions.redo import parse_update
from tidemark.functions.images import delta, full_after
from tidemark.operators import filters, joins, positions, routing
from tidemark.schema import LOG_SCHEMA, reject_reason, to_event
from tidemark.sources import catalogs, connectors, logs, snapshots
from tidemark.streaming import sinks

from test_transactions import log_frame


def test_load_connectors(spark, tmp_path):
    files = {
        "a.json": {"name": "pg", "class": "x.PostgresAdapter", "config": {"port": 5432, "password": "p", "url": "jdbc:x?password=p&a=b"}},
        "b.json": {"name": "my", "type": "mysql", "config": {}},
        "c.json": {"name": "odd", "class": "x.Db2", "config": {}},
        "d.json": {"class": "x.Oracle", "config": {}},
    }
    for name, doc in files.items():
        (tmp_path / name).write_text(json.dumps(doc, indent=2))
    (tmp_path / "e.json").write_text('{"name": "broken"')
    (tmp_path / "notes.txt").write_text("not a config")
    loaded = connectors.load_connectors(spark, str(tmp_path))
    assert sorted((r["name"] or "", r["error"] or "") for r in loaded.collect()) == [
        ("", "name missing"), ("", "not JSON"), ("my", ""), ("odd", "unknown kind"), ("pg", "")
    ]
    usable = connectors.usable_connectors(loaded)
    shown = {r["name"]: r["m"] for r in usable.select("name", connectors.masked(F.col("config")).alias("m")).collect()}
    assert shown["pg"] == {"port": "5432", "password": "****", "url": "jdbc:x?password=****&a=b"}
    assert connectors.load_connectors(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "empty").mkdir()
    assert connectors.load_connectors(spark, str(tmp_path / "empty")).count() == 0


GOLDEN = """{
  "eventId": "f47ac10b-58cc-4372-a567-0e02b2c3d479", "operation": "UPDATE", "timestamp": "2026-05-25T14:30:15Z",
  "source": {"connectorName": "oracle-rh", "connectorType": "oracle", "database": "ORCLPDB1", "schema": "RH",
    "table": "FUNCIONARIOS", "transactionId": "ora-tx-4500122", "offsetCoordinates": {"scn": "4500122"}},
  "before": {"ID": "158", "NOME": "Ana Souza", "CARGO": "Estagiário", "DEPARTAMENTO": "Inteligência"},
  "after": {"CARGO": "Analista de Desenvolvimento"}}"""


def test_golden_event(spark):
    """An update statement becomes the documented message, text for text."""
    sql = (
        """update "RH"."FUNCIONARIOS" set "CARGO" = 'Analista de Desenvolvimento', "NOME" = 'Ana Souza' """
        """where "ID" = '158' and "NOME" = 'Ana Souza' and "CARGO" = 'Estagiário' and "DEPARTAMENTO" = 'Inteligência';"""
    )
    row = spark.createDataFrame([(sql,)], "sql STRING").select(parse_update(F.col("sql")).alias("u")).select(
        F.lit("oracle-rh").alias("connector"), F.lit("oracle").alias("connector_type"), F.lit("ORCLPDB1").alias("database"),
        F.lit("RH").alias("schema"), F.lit("FUNCIONARIOS").alias("table"), F.lit("ora-tx-4500122").alias("tx"),
        F.lit("UPDATE").alias("op"), F.lit("2026-05-25 14:30:15").cast("timestamp").alias("ts"), F.lit(4500122).alias("ord"),
        F.lit(0).alias("ordinal"), F.lit("4500122").alias("offset"), F.col("u.before").alias("before"),
        delta(F.col("u.before"), F.col("u.assigned")).alias("after"), F.current_timestamp().alias("ingested_at"),
    )
    message = routing.messages(row).first()
    golden = json.loads(GOLDEN)
    expected = json.dumps(golden | {"eventId": message["key"]}, separators=(",", ":"), ensure_ascii=False)
    assert message["value"] == expected
    assert message["topic"] == "cdc.oracle-rh.RH.FUNCIONARIOS"
    parsed = logs.events_from_json(spark.createDataFrame([(GOLDEN,)], "value STRING")).first()
    assert parsed["reason"] is None and parsed["offset"] == "4500122" and parsed["after"] == golden["after"]
    assert str(parsed["ts"]) == "2026-05-25 14:30:15"


def test_json_nulls_and_fractions(spark):
    log = log_frame(spark, [("a", "1", "INSERT", 1)])
    value = json.loads(routing.messages(log).first()["value"])
    assert value["before"] is None and value["timestamp"] == "1970-01-12T13:46:41Z"
    odd = log.withColumn("ts", F.timestamp_micros(F.lit(1_500_000))).unionByName(log.withColumn("ts", F.timestamp_micros(F.lit(-1))))
    stamps = [json.loads(r["value"])["timestamp"] for r in routing.messages(odd).collect()]
    assert stamps == ["1970-01-01T00:00:01.500Z", "1969-12-31T23:59:59.999999Z"]


def test_bad_events_get_a_reason(spark):
    texts = ['{"eventId": "1", "operation": "INSERT", "source": {"connectorName": "c"}}', "junk", '{"eventId": "1"}',
             '{"operation": "INSERT", "source": {"connectorName": "c"}}', '{"eventId": "1", "operation": "MERGE", "source": {"connectorName": "c"}}',
             '{"eventId": "1", "operation": "INSERT"}', None]
    frame = spark.createDataFrame([(t,) for t in texts], "value STRING")
    assert [r["reason"] for r in logs.events_from_json(frame).collect()] == [
        None, "not JSON", "operation missing", "event id missing", "operation unknown", "source missing", "not JSON"
    ]


def test_routing_and_keys(spark):
    log = log_frame(spark, [("a", "1", "INSERT", 1), ("a", "1", "COMMIT", 2)])
    assert [r["topic"] for r in routing.route(log).collect()] == ["cdc.a.public.t"]
    no_schema = log.where("op = 'INSERT'").withColumn("schema", F.lit(None).cast("string"))
    assert routing.route(no_schema).first()["topic"] == "cdc.a.null.t"
    assert routing.messages(log, key="pk", pk=F.col("after")["v"]).first()["key"] == "1"
    with pytest.raises(ValueError):
        routing.messages(log, key="pk")


def test_offsets(spark):
    cases = [("postgres", "0/16B6C50", (0, 0x16B6C50)), ("postgres", "1/0", (0, 2**32)), ("postgres", "FFFFFFFF/FFFFFFFF", (0, 2**64 - 1)),
             ("postgres", "x/y", None), ("mysql", "mysql-bin.000012:154", (12, 154)), ("mysql", "broken", None),
             ("oracle", "4500122", (0, 4500122)), ("oracle", "", None)]
    frame = spark.createDataFrame([(k, t) for k, t, _ in cases], "k STRING, t STRING")
    found = [r["o"] for r in frame.select(offset_key(F.col("k"), F.col("t")).alias("o")).collect()]
    assert [None if o is None else (o["file"], int(o["position"])) for o in found] == [e for _, _, e in cases]
    maps = [({"binlog_pos": "b", "lsn": "l"}, "l"), ({"x": "1", "binlog_pos": "b"}, "b"), ({"scn": "7"}, "7"), ({}, ""), (None, "")]
    frame = spark.createDataFrame([(m,) for m, _ in maps], "m MAP<STRING,STRING>")
    assert [r[0] for r in frame.select(offset_value(F.col("m"))).collect()] == [e for _, e in maps]


def test_resume_is_inclusive(spark):
    log = log_frame(spark, [("a", "1", "INSERT", i) for i in (5, 9, 10, 11)] + [("b", "1", "INSERT", 1)])
    stored = spark.createDataFrame([("a", " 10 "), ("b", "  ")], "connector STRING, offset STRING")
    assert sorted(r["ord"] for r in positions.resume(log, stored).collect()) == [1, 10, 11]
    assert sorted(r["ord"] for r in positions.resume(log, stored, inclusive=False).collect()) == [1, 11]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_side_join_without_broadcast(spark, how):
    """A side too large to broadcast gives the same, with a key that holds most rows."""
    rows = spark.range(500).select(F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"), "id")
    side = spark.createDataFrame([(1, "x"), (9, "y"), (9, "z"), (-1, "w")], "k BIGINT, v STRING")
    small = sorted(map(repr, joins.side_join(rows, side, ["k"], how).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = sorted(map(repr, joins.side_join(rows, side, ["k"], how).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert small == large


def test_snapshot(spark):
    t = spark.createDataFrame([(1, None), (2, "b")], "id INT, v STRING")
    u = spark.createDataFrame([(1,)], "id INT")
    at = F.lit("2024-01-01").cast("timestamp")
    snap = snapshots.snapshot_events(spark, {("s", "t"): t, ("s", "u"): u}, "c", "postgres", "d", "0/10", at,
                                     {("s", "t"): F.col("id"), ("s", "u"): F.col("id")})
    rows = snap.orderBy("ord", "ordinal").collect()
    assert [r["op"] for r in rows] == ["BEGIN", "READ", "READ", "READ", "COMMIT"]
    assert [r["after"] for r in rows[1:4]] == [{"id": "1", "v": None}, {"id": "1"}, {"id": "2", "v": "b"}]
    assert all(r["ord"] < 0 for r in rows) and {r["tx"] for r in rows} == {"snapshot-tx"}
    assert to_event(snap).select("eventId").distinct().count() == 5
    assert snap.schema.simpleString() == LOG_SCHEMA.simpleString()


def test_jdbc_options():
    plain = snapshots.jdbc_options("jdbc:x", "(select * from t as of scn 5) q")
    assert plain == {"url": "jdbc:x", "dbtable": "(select * from t as of scn 5) q", "fetchsize": "10000"}
    split = snapshots.jdbc_options("jdbc:x", "t", "id", 0, 100, 4, session_init="begin")
    assert (split["numPartitions"], split["lowerBound"], split["sessionInitStatement"]) == ("4", "0", "begin")
    with pytest.raises(ValueError):
        snapshots.jdbc_options("jdbc:x", "t", "id")


def test_kafka_rows_keep_their_place(spark):
    """Offsets repeat between partitions."""
    raw = spark.sql("select cast('{}' as binary) as value, 'cdc.a' as topic, p as partition, 7L as offset, now() as timestamp from values (0), (1) as t(p)")
    rows = logs.kafka_rows(raw).select("value", "topic", "partition", "ord").collect()
    assert sorted(map(tuple, rows)) == [("{}", "cdc.a", 0, 7), ("{}", "cdc.a", 1, 7)]


def test_kafka_options():
    assert sinks.kafka_options("h:9092")["kafka.acks"] == "all"
    assert logs.kafka_source_options("h:9092", "cdc.*")["startingOffsets"] == "earliest"


def test_catalog_and_segments(spark):
    info = spark.createDataFrame([("d", "t", "b", 2), ("d", "t", "a", 10), ("d", "t", "c", 1), ("d", "t", "c", 1)],
                                 "schema STRING, table STRING, column STRING, position INT")
    assert catalogs.column_dictionary(info).first()["names"] == ["c", "b", "a"]
    groups = spark.createDataFrame([(1, "INACTIVE", 5)], "group INT, status STRING, first_change BIGINT")
    assert catalogs.safe_start(groups).first()["start"] == 0
    assert catalogs.safe_start(groups.withColumn("status", F.lit("ACTIVE"))).first()["start"] == 5


def test_filters(spark):
    redo = spark.createDataFrame(
        [("c", 1, "INSERT", "T", "x", "a", 1), ("c", 1, "INSERT", "T", "x", "b", 2), ("c", 2, "INSERT", "T", "x", "a", 3)],
        "connector STRING, scn BIGINT, operation STRING, table_name STRING, sql_redo STRING, tx_name STRING, ord BIGINT")
    assert sorted(r["ord"] for r in filters.dedup_fingerprint(redo, order="ord").collect()) == [1, 3]
    assert filters.dedup_fingerprint(redo).count() == 2
    assert filters.dedup_fingerprint(redo, [*filters.FINGERPRINT, "tx_name"]).count() == 3
    good, dead = filters.split_dlq(redo, F.when(F.col("ord") == 2, F.lit("bad")), F.lit("v = 'secret'"))
    assert good.count() == 2
    assert dead.first().asDict() == {"topic": "cdc.dlq.c", "connector": "c", "reason": "bad", "payload": "v = '?'", "ord": 2}


def test_full_after(spark):
    frame = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3", "c": None}), (None, {"x": "1"}), ({"x": "1"}, None)],
                                  "b MAP<STRING,STRING>, a MAP<STRING,STRING>")
    assert [r[0] for r in frame.select(full_after(F.col("b"), F.col("a"))).collect()] == [
        {"a": "1", "b": "3", "c": None}, {"x": "1"}, None
    ]


def test_reject_reason(spark):
    frame = spark.createDataFrame([("INSERT", "c"), (None, "c"), ("X", "c"), ("READ", None)], "op STRING, connector STRING")
    assert [r[0] for r in frame.select(reject_reason()).collect()] == [None, "operation missing", "operation unknown", "source missing"]
