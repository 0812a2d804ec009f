"""How much work the streams do: what is shuffled, and how often a row is evaluated."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import queries
from tidemark.schema import LOG_SCHEMA
from tidemark.sources import logs
from tidemark.streaming import gate, incremental
from tests.test_mysql import MAP, frame, names


def test_an_empty_horizon_shuffles_no_rows(spark, tmp_path):
    """A join with it brought all rows of a connector to one task."""
    state = gate._State(spark, str(tmp_path), LOG_SCHEMA, 0, 16)
    rows = spark.range(100).select(F.lit("c").alias("connector"), F.col("id").alias("ord"))
    placed = rows.alias("r").join(state.horizon.alias("h"), gate._same(["connector"], "r", "h"), "left")
    assert "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()
    assert placed.count() == 100


def test_batches_land_in_many_files(spark, tmp_path):
    """Each batch was one file, read by one task."""
    events = spark.range(2000).selectExpr(
        "id as event_id", "timestamp_seconds(1704067200 + id * 60) as ts", "id % 50 as user_id",
        "case id % 3 when 0 then 'signup' when 1 then 'view' else 'error' end as event_type",
        "cast(id as double) as value", "'{}' as props")
    events.write.parquet(f"{tmp_path}/events.parquet")
    tasks = []

    def of(batch):
        tasks.append(batch.rdd.getNumPartitions())
        return batch.where("op <> 'COMMIT'").groupBy("op").agg(F.count("*").alias("events"))

    parts = queries._parts(spark, str(tmp_path), "counts", of)
    assert parts.agg(F.sum("events")).first()[0] == 2000
    assert len(tasks) == queries.STREAM_BATCHES and min(tasks) > 1


def test_pieces(spark, tmp_path):
    rows = spark.createDataFrame([(i, None if i == 7 else i % 3) for i in range(30)], "v INT, p BIGINT")
    piece_of = queries._pieces(rows, "p", f"{tmp_path}/pieces")
    for n in range(4):
        found = piece_of(n)
        assert found.columns == ["v", "p"]
        assert sorted(r["v"] for r in found.collect()) == [i for i in range(30) if i != 7 and i % 3 == n]
    assert queries._pieces(rows.limit(0), F.col("p"), f"{tmp_path}/none")(0).count() == 0


@pytest.fixture
def evaluated(spark, monkeypatch):
    """Wraps a function of rows in this module so that evaluations of its rows are counted."""
    counter = spark.sparkContext.accumulator(0)

    def seen(reason):
        counter.add(1)
        return reason

    counted = F.udf(seen, "string").asNondeterministic()

    def wrap(name):
        original = getattr(incremental, name)
        monkeypatch.setattr(incremental, name, lambda *a, **k: original(*a, **k).withColumn("reason", counted("reason")))
        return counter

    return wrap


def test_redo_is_parsed_once(spark, tmp_path, evaluated):
    counter = evaluated("redo_events")
    sql = "case id % 4 when 0 then 'merge' else concat('delete from T where K = ', id, ';') end"
    spark.range(40).selectExpr(
        "'o' as connector", "id as ord", "id as scn", f"{sql} as sql_redo", "'DELETE' as operation", "'T' as table_name",
        "'FIN' as seg_owner", "'C' as src_con_name", "cast(null as string) as tx_name",
        "timestamp_seconds(id) as timestamp", "timestamp_seconds(id) as ingested_at").write.parquet(f"{tmp_path}/landed")
    stream = logs.stream_change_log(spark, f"{tmp_path}/landed", "oracle")
    incremental.publish_redo(stream, f"{tmp_path}/out", f"{tmp_path}/ck", "FIN").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out/events").count() == 30
    assert spark.read.parquet(f"{tmp_path}/out/dead_letters").count() == 10
    assert counter.value == 40


def test_raw_rows_are_normalised_once(spark, tmp_path, evaluated):
    counter = evaluated("normalise")
    entries = [(1, "TABLE_MAP", MAP)]
    entries += [(n, "WRITE", {"table_id": 1, "rows": [(None, [str(n), "v"])]}) for n in range(2, 22)]
    frame(spark, [*entries, (22, "XID", {})]).write.parquet(f"{tmp_path}/landed")
    stream = logs.stream_change_log(spark, f"{tmp_path}/landed", "mysql")
    incremental.publish_raw(stream, "mysql", f"{tmp_path}/out", f"{tmp_path}/ck", dictionary=names(spark)).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out/events").count() == 20
    assert counter.value <= 22
