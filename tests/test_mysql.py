"""Binlog events: table maps, markers, row lists, names."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.mysql import binlog_events
from tidemark.operators.transactions import commit_gate
from tidemark.sources.logs import BINLOG_SCHEMA


def frame(spark, events):
    rows = []
    for ord_, event, extra in events:
        rows.append({
            "connector": "m", "server_id": 1, "ord": ord_, "file": "f.000001", "pos": ord_ * 10, "event": event,
            "header_ts": None, "table_id": None, "db": None, "table": None, "sql": None, "rows": None, "ingested_at": None, "gtid": None,
        } | extra)
    columns = ["connector", "server_id", "ord", "file", "pos", "event", "header_ts", "table_id", "db", "table", "sql", "rows", "ingested_at", "gtid"]
    log = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows],
                                BINLOG_SCHEMA.replace("header_ts TIMESTAMP", "header_ts BIGINT"))
    return log.withColumn("header_ts", F.timestamp_seconds("header_ts"))


def names(spark, rows=(("d", "t", ["id", "v"]),)):
    return spark.createDataFrame(list(rows), "schema STRING, table STRING, names ARRAY<STRING>")


MAP = {"table_id": 1, "db": "d", "table": "t"}


def test_rows_and_ids(spark):
    log = frame(spark, [
        (0, "WRITE", {"table_id": 1, "rows": [(None, ["0"])]}),
        (1, "TABLE_MAP", MAP),
        (2, "WRITE", {"table_id": 1, "rows": [(None, ["1", "a", "x"]), (None, ["2"])]}),
        (3, "UPDATE", {"table_id": 1, "rows": [(["1", "a"], ["1", None])]}),
        (4, "QUERY", {"sql": " Commit "}), (5, "QUERY", {"sql": "BEGIN"}),
        (6, "TABLE_MAP", {"table_id": 1, "db": "other", "table": "u"}),
        (7, "DELETE", {"table_id": 1, "rows": [(["9"], None)]}),
        (8, "XID", {}), (9, "TABLE_MAP", MAP), (10, "DELETE", {"table_id": 1, "rows": [(["1", "a"], None)]}),
    ])
    for bits in (1, 18):
        found = {(r["ord"], r["ordinal"]): r for r in binlog_events(log, names(spark), bits=bits).collect()}
        assert (0, 0) not in found and (5, 0) not in found
        assert found[2, 0]["after"] == {"id": "1", "v": "a", "col_2": "x"} and found[2, 0]["before"] is None
        assert found[2, 1]["after"] == {"id": "2"}
        assert (found[3, 0]["before"], found[3, 0]["after"]) == ({"id": "1", "v": "a"}, {"id": "1", "v": None})
        assert (found[7, 0]["database"], found[7, 0]["before"], found[7, 0]["after"]) == ("other", {"col_0": "9"}, None)
        assert [found[k]["tx"] for k in ((2, 0), (3, 0), (7, 0), (10, 0))] == ["0", "0", "1", "2"]
        assert [found[k]["commit_ord"] for k in ((2, 0), (3, 0), (7, 0), (10, 0))] == [4, 4, 8, None]
        assert found[2, 0]["commit_offset"] == "f.000001:40"
        assert (found[4, 0]["op"], found[8, 0]["op"], found[1, 0]["op"]) == ("COMMIT", "COMMIT", "BEGIN")
    only = binlog_events(log, names(spark), "d").where("op in ('INSERT','UPDATE','DELETE')").collect()
    assert {r["database"] for r in only} == {"d"}


def test_header_ids_merge_one_second(spark):
    log = frame(spark, [
        (1, "TABLE_MAP", MAP | {"header_ts": 5}), (2, "WRITE", {"table_id": 1, "rows": [(None, ["1"])], "header_ts": 5}),
        (3, "XID", {"header_ts": 6}), (4, "WRITE", {"table_id": 1, "rows": [(None, ["2"])], "header_ts": 6}),
        (5, "XID", {"header_ts": 6}),
    ])
    rows = binlog_events(log, names(spark), mode="header").drop("commit_ord", "commit_ts", "commit_offset")
    # The first row's commit carries another second, so it is never released.
    assert [(r["ord"], r["tx"]) for r in commit_gate(rows).collect()] == [(4, "tx-1-6000")]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        binlog_events(frame(spark, []), names(spark), mode="gtid")
