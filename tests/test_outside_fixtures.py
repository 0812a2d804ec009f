"""Cases that the registered queries' inputs do not hold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.identity import iso_instant
from tidemark.functions.pgbytes import relation_definition
from tidemark.functions.redo import parse_delete, parse_insert, parse_update
from tidemark.operators.metrics import replication_lag
from tidemark.operators.positions import resume
from tidemark.plans import fixtures
from tidemark.plans.normalise import normalise, publishable
from tidemark.sources.catalogs import column_dictionary

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_instants_do_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = [(1710037800_000000,), (1710037800_120000,), (1710037800_000001,), (-1,), (None,)]
        out = spark.createDataFrame(micros, "m long").select(iso_instant(F.timestamp_micros("m"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r[0] for r in out] == [
        "2024-03-10T02:30:00Z", "2024-03-10T02:30:00.120Z", "2024-03-10T02:30:00.000001Z", "1969-12-31T23:59:59.999999Z", None]


def test_lag_leaves_out_rows_that_have_not_landed(spark):
    at = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [("a", at, at + dt.timedelta(seconds=2)), ("a", at, None), ("a", None, at)], "connector string, ts timestamp, ingested_at timestamp")
    row = replication_lag(log).first()
    assert (row["events"], row["total_ms"]) == (1, 2000)


@pytest.mark.parametrize("declared,names", [(1, ["a"]), (3, None), (0, None)])
def test_relation_with_another_number_of_columns_has_no_names(spark, declared, names):
    message = b"R\0\0\0\1public\0t\0d" + declared.to_bytes(2, "big") + b"\0a\0" + b"\0" * 8
    row = spark.createDataFrame([(bytearray(message),)], "payload binary").select(relation_definition(F.col("payload")).alias("d")).first()["d"]
    assert (row["schema"], row["table"], row["names"]) == ("public", "t", names)


def test_rows_of_a_truncated_relation_are_dead_letters(spark):
    relation = b"R\0\0\0\1public\0t\0d\0\3" + b"\0a\0" + b"\0" * 8
    insert = b"I\0\0\0\1N\0\1t\0\0\0\1x"
    log = spark.createDataFrame(
        [("c", "d", i, str(i), bytearray(m), None) for i, m in enumerate((relation, insert))],
        "connector string, database string, ord long, offset string, payload binary, ingested_at timestamp")
    assert [r["reason"] for r in publishable(normalise("postgres", log))[2].collect()] == ["relation malformed"]


def test_row_events_without_a_table_map_are_dead_letters(spark):
    raw = fixtures.binlog(spark, SF)
    dictionary = column_dictionary(fixtures.column_catalog(spark, SF))
    unmapped = {(r["connector"], r["ord"]) for r in raw.where("table_id = 3").collect()}
    for database in (None, "financeiro"):
        dead = publishable(normalise("mysql", raw, dictionary=dictionary, database=database))[2].collect()
        assert unmapped and {(r["connector"], r["ord"]) for r in dead} == unmapped and len(dead) == len(unmapped)


@pytest.mark.parametrize("depth", [1, 3, 4, 8])
def test_calls_of_any_depth_are_understood(spark, depth):
    value = "'a(b''c﷐'"
    for i in range(depth):
        value = f"F{i}(G(), {value}, H(1))"
    texts = [f"insert into T(A,B) values ({value},'(x﷐')", f"update T set A = {value} where B = {value}", f"delete from T where A = {value};"]
    row = spark.createDataFrame([tuple(texts)], "i string, u string, d string").select(
        parse_insert(F.col("i")).alias("i"), parse_update(F.col("u")).alias("u"), parse_delete(F.col("d")).alias("d")).first()
    assert row["i"] == {"A": value, "B": "(x﷐"}
    assert (row["u"]["assigned"], row["u"]["before"], row["d"]) == ({"A": value}, {"B": value}, {"A": value})


def test_resume_keeps_unreadable_rows_and_takes_the_greatest_position(spark):
    log = spark.createDataFrame(
        [("o", "oracle", "5"), ("o", "oracle", "9"), ("o", "oracle", "junk"), ("o", "oracle", None), ("p", "oracle", "1")],
        "connector string, connector_type string, offset string")
    stored = spark.createDataFrame([("o", "6"), ("o", "9")], "connector string, offset string")
    assert sorted(map(str, (r["offset"] for r in resume(log, stored).collect()))) == ["1", "9", "None", "junk"]
