"""Registered queries: one per operator, each over whole tables.

Results are flat scalar columns. Times are microseconds since 1970 so that they compare
without zones.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions import gtid as gtids
from tidemark.functions.images import delta, full_after, name_columns
from tidemark.functions.offsets import offset_key, offset_value
from tidemark.functions.identity import offset_map
from tidemark.functions.redo import obfuscate_sql, parse_insert
from tidemark.operators import filters, gtid, lake, metrics, positions, routing
from tidemark.operators import transactions as tx
from tidemark.operators.mysql import binlog_events, resolve as resolve_binlog
from tidemark.operators.oracle import redo_events, redo_images, redo_rows
from tidemark.operators.postgres import pg_events, pg_messages
from tidemark.plans import fixtures
from tidemark.plans.normalise import normalise, publishable
from tidemark.schema import LOG_SCHEMA, TOAST_SENTINEL, from_event, to_event, with_event_id
from tidemark.sources import catalogs, connectors, logs, manifest, snapshots
from tidemark.streaming import gate, incremental, rollups, sinks, state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Server ids of the binlog with transaction ids.
SERVER_A, SERVER_B = "0a000000-0000-0000-0000-00000000000a", "0b000000-0000-0000-0000-00000000000b"
TAKEN_AT = "timestamp_micros(1704067200000000)"


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def us(column: str | Column) -> Column:
    return F.unix_micros(column)


def item(image: str, name: str) -> Column:
    return F.try_element_at(F.col(image), F.lit(name))


def tx_number() -> Column:
    return F.col("tx").cast("bigint")


# --- flagship -----------------------------------------------------------------------


@query("committed_by_topic")
def committed_by_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Committed changes per topic and operation: gate, leave out markers, route, count."""
    routed = routing.route(tx.commit_gate(fixtures.change_log(spark, sf)))
    return routed.groupBy("topic", "op").agg(F.count("*").alias("events"))


# --- sources ------------------------------------------------------------------------


def _config_texts(spark: SparkSession, sf: str) -> DataFrame:
    """A connector document per supplier; some are broken."""
    return spark.sql(
        """
        select case
            when s_suppkey % 10 = 7 then concat('{{"name": "c', cast(s_suppkey as string), '", "class"')
            when s_suppkey % 10 = 8 then concat('{{"name": "c', cast(s_suppkey as string), '", "class": "x.MySqlAdapter"}}')
            else concat('{{"name": "c', cast(s_suppkey as string), '", "class": "x.y.',
              case s_suppkey % 3 when 0 then 'Postgres' when 1 then 'MySql' else 'Oracle' end,
              'Adapter", "config": {{"port": ', cast(3000 + s_suppkey as string),
              ', "password": "p', cast(s_suppkey as string), '", "database": "fin"}}}}') end as value
        from {s}
        """,
        s=fixtures.table(spark, sf, "supplier"),
    )


@query("connectors")
def connectors_parsed(spark: SparkSession, sf: str) -> DataFrame:
    found = connectors.parse_connectors(_config_texts(spark, sf))
    shown = found.withColumn("config", connectors.masked(F.col("config")))
    return shown.select(
        "name", "type", item("config", "port").alias("port"), item("config", "password").alias("password"),
        item("config", "database").alias("database"), "error",
    )


def _snapshot(spark: SparkSession, sf: str) -> DataFrame:
    customer = fixtures.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = fixtures.table(spark, sf, "nation").select("n_nationkey", "n_name")
    return snapshots.snapshot_events(
        spark,
        {("fin", "customer"): customer, ("fin", "nation"): nation},
        "my-fin", "mysql", "fin", "mysql-bin.000002:154", F.expr(TAKEN_AT),
        {("fin", "customer"): F.col("c_custkey"), ("fin", "nation"): F.col("n_nationkey")},
    )


@query("snapshot_events")
def snapshot_events(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshot(spark, sf).select(
        "op", "schema", "table", "tx", "ord", "ordinal", "offset", us("ts").alias("ts_us"),
        F.coalesce(item("after", "c_custkey"), item("after", "n_nationkey")).alias("id"),
        F.coalesce(item("after", "c_name"), item("after", "n_name")).alias("name"),
        item("after", "c_nationkey").alias("nation"),
    )


@query("snapshot_counts")
def snapshot_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.snapshot_counts(tx.commit_gate(_snapshot(spark, sf)))


@query("snapshot_needed")
def snapshot_needed(spark: SparkSession, sf: str) -> DataFrame:
    known = fixtures.table(spark, sf, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("name"), F.lit("postgres").alias("type")
    )
    stored = fixtures.table(spark, sf, "orders").select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("connector"),
        F.when(F.col("o_orderstatus") == "F", F.lit("0/16B6C50")).otherwise(F.lit(" ")).alias("offset"),
    )
    return snapshots.snapshot_needed(known, stored)


@query("snapshot_then_log")
def snapshot_then_log(spark: SparkSession, sf: str) -> DataFrame:
    log = fixtures.change_log(spark, sf).where(F.col("connector") == "my-fin").drop("pk")
    joined = snapshots.snapshot_then_log(_snapshot(spark, sf), log, "mysql-bin.000000:1540")
    return joined.groupBy("op", "table").agg(F.count("*").alias("n_rows"), F.min("ord").alias("first_ord"))


def _event_json(spark: SparkSession, sf: str) -> DataFrame:
    return routing.messages(fixtures.change_log(spark, sf), keep=("ord",))


def _flat_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "connector", "connector_type", "schema", "table", tx_number().alias("tx"), "op",
        us("ts").alias("ts_us"), "offset", item("before", "cents").alias("old_cents"),
        item("after", "cents").alias("new_cents"), item("after", "props").alias("new_props"),
    )


@query("read_events_json")
def read_events_json(spark: SparkSession, sf: str) -> DataFrame:
    events = logs.events_from_json(_event_json(spark, sf))
    return _flat_events(events.where(F.col("reason").isNull()))


@query("stream_events")
def stream_events(spark: SparkSession, sf: str) -> DataFrame:
    """Event JSON landed as text files, read as a stream into parquet."""
    base = sinks.scratch_dir(spark, "events")
    _event_json(spark, sf).select("value").write.text(f"{base}/landed")
    texts = spark.readStream.schema("value STRING").format("text").load(f"{base}/landed")
    events = logs.events_from_json(texts).where(F.col("reason").isNull())
    sinks.run_available(_flat_events(events), f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


@query("scope_filter")
def scope_filter(spark: SparkSession, sf: str) -> DataFrame:
    log = fixtures.change_rows(spark, sf)
    published = log.where(F.col("table") != "t3").select("schema", "table").distinct()
    return filters.tables_in_scope(log, published).select("connector", "table", "ord", "op")


@query("column_dictionary")
def column_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    names = catalogs.column_dictionary(fixtures.column_catalog(spark, sf))
    return names.select("schema", "table", F.array_join("names", ",").alias("names"))


def _segments(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    events = fixtures.table(spark, sf, "events")
    archived = spark.sql(
        """
        select concat('/arc/', cast(c as string), '_', cast(event_id as string)) as name,
          (event_id + 1) * 10 as next_change, case when event_id % 7 = 0 then 'D' else 'A' end as status,
          event_id % 2 as thread, cast(floor(event_id / 2) as bigint) as sequence
        from {e} lateral view explode(array(2, 1)) as c where event_type <> 'view'
        """,
        e=events,
    )
    groups = spark.sql(
        """
        select event_id as group, case event_id % 3 when 0 then 'CURRENT' when 1 then 'ACTIVE' else 'INACTIVE' end as status,
          event_id * 10 + 5 as first_change
        from {e} where event_type = 'view'
        """,
        e=events,
    )
    members = spark.sql(
        """
        select event_id as group, concat(case when event_id % 50 = 0 then '  ' else concat('/redo/', c, '_', cast(event_id as string)) end) as member
        from {e} lateral view explode(array('b', 'a')) as c where event_type = 'view'
        """,
        e=events,
    )
    return archived, groups, members


@query("prune_segments")
def prune_segments(spark: SparkSession, sf: str) -> DataFrame:
    return catalogs.prune_log_segments(*_segments(spark, sf), start=5000)


@query("safe_start")
def safe_start(spark: SparkSession, sf: str) -> DataFrame:
    return catalogs.safe_start(_segments(spark, sf)[1])


# --- normalise ----------------------------------------------------------------------


def _status(image: str) -> Column:
    """Name of the status column in an image, which changes as the log goes on."""
    return F.array_join(F.filter(F.map_keys(image), lambda k: k.startswith("status")), ",")


@query("pg_decode")
def pg_decode(spark: SparkSession, sf: str) -> DataFrame:
    rows = pg_events(fixtures.pg_log(spark, sf))
    return rows.where(tx.is_data() & F.col("reason").isNull()).select(
        "connector", "ord", "op", "schema", "table", "tx", "commit_ord",
        item("before", "o_orderkey").alias("old_key"), item("before", "o_anotação").alias("old_note"),
        item("after", "o_orderkey").alias("new_key"), item("after", "o_anotação").alias("new_note"),
        item("after", "col_unknown_3").alias("surplus"),
        F.when(F.col("after").isNull(), F.lit(0)).otherwise(F.size("after")).alias("n_after"),
        F.coalesce(_status("after"), F.lit("")).alias("status_name"),
    )


@query("relation_asof")
def relation_asof(spark: SparkSession, sf: str) -> DataFrame:
    rows = pg_events(fixtures.pg_log(spark, sf)).where(tx.is_data())
    name = F.coalesce(_status("after"), _status("before"))
    return rows.groupBy("connector", "table", "reason", name.alias("status_name")).agg(F.count("*").alias("n_rows"))


@query("tx_interval")
def tx_interval(spark: SparkSession, sf: str) -> DataFrame:
    rows = pg_events(fixtures.pg_log(spark, sf)).where(tx.is_data())
    return rows.groupBy("connector", tx_number().alias("tx")).agg(
        F.count("*").alias("n_rows"),
        F.max("commit_ord").alias("commit_ord"),
        us(F.max("commit_ts")).alias("commit_us"),
        F.max("commit_offset").alias("commit_offset"),
    )


@query("pg_ts")
def pg_ts(spark: SparkSession, sf: str) -> DataFrame:
    markers = pg_messages(fixtures.pg_log(spark, sf)).where(F.col("type").isin("B", "C"))
    return markers.select("connector", "ord", "type", "xid", us("event_ts").alias("ts_us"))


@query("name_columns")
def name_columns_positional(spark: SparkSession, sf: str) -> DataFrame:
    orders = fixtures.table(spark, sf, "orders")
    values = F.slice(
        F.array(F.col("o_custkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority")),
        F.lit(1), (F.col("o_orderkey") % 4).cast("int"),
    )
    names = F.array(F.lit("cust"), F.lit("status"))
    named = orders.select("o_orderkey", name_columns(values, names).alias("image"))
    return named.select(
        "o_orderkey", F.size("image").alias("n"), item("image", "cust").alias("cust"),
        item("image", "status").alias("status"), item("image", "col_2").alias("col_2"),
    )


def _binlog_rows(spark: SparkSession, sf: str, database: str | None = None, mode: str = "positional") -> DataFrame:
    names = catalogs.column_dictionary(fixtures.column_catalog(spark, sf))
    return binlog_events(fixtures.binlog(spark, sf), names, database, mode)


@query("binlog_rows")
def binlog_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _binlog_rows(spark, sf).where(tx.is_data()).select(
        "connector", "ord", "ordinal", "op", "database", "table",
        F.coalesce(item("before", "o_cust"), item("before", "col_0")).alias("old_cust"),
        F.coalesce(item("before", "o_status"), item("before", "col_1")).alias("old_status"),
        F.coalesce(item("after", "o_cust"), item("after", "col_0")).alias("new_cust"),
        F.coalesce(item("after", "o_status"), item("after", "col_1")).alias("new_status"),
        item("after", "col_2").alias("new_col_2"),
        F.coalesce(F.map_contains_key("after", "o_cust"), F.map_contains_key("before", "o_cust")).alias("named"),
    )


@query("table_map_asof")
def table_map_asof(spark: SparkSession, sf: str) -> DataFrame:
    rows = resolve_binlog(fixtures.binlog(spark, sf)).where(F.col("event").isin("WRITE", "UPDATE", "DELETE"))
    return rows.groupBy("connector", "table_id", F.col("mapped.db").alias("db"), F.col("mapped.table").alias("table")).agg(
        F.count("*").alias("n_events")
    )


@query("binlog_tx")
def binlog_tx(spark: SparkSession, sf: str) -> DataFrame:
    rows = _binlog_rows(spark, sf).where(tx.is_data())
    return rows.groupBy("connector", tx_number().alias("tx")).agg(
        F.count("*").alias("n_rows"), F.max("commit_ord").alias("commit_ord"),
        F.max("commit_offset").alias("commit_offset"), us(F.max("commit_ts")).alias("commit_us"),
    )


@query("binlog_tx_header")
def binlog_tx_header(spark: SparkSession, sf: str) -> DataFrame:
    """Ids from event headers, and the commit each row waits for under such an id."""
    log = _binlog_rows(spark, sf, "financeiro", "header").drop("commit_ord", "commit_ts", "commit_offset")
    return tx.attribute_commits(log).select("connector", "tx", "ord", "ordinal", "commit_ord")


def _binlog_with_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The binlog as landed with transaction ids: numbers without gaps per connector, the
    server changes every 50 transactions. Table maps have none."""
    number = F.floor(F.col("ord") / 80).cast("bigint")
    server = F.when(F.floor(number / 50) % 2 == 0, F.lit(SERVER_A)).otherwise(F.lit(SERVER_B))
    found = F.concat_ws(":", server, (number + 1).cast("string"))
    return fixtures.binlog(spark, sf).withColumn("gtid", F.when(F.col("event") != "TABLE_MAP", found))


def _executed(binlog: DataFrame) -> DataFrame:
    """Commits of all transactions but every seventh."""
    return binlog.where(F.col("event").isin("XID", "QUERY") & (F.floor(F.col("ord") / 80) % 7 != 6))


@query("binlog_tx_gtid")
def binlog_tx_gtid(spark: SparkSession, sf: str) -> DataFrame:
    names = catalogs.column_dictionary(fixtures.column_catalog(spark, sf))
    rows = binlog_events(_binlog_with_ids(spark, sf), names, mode="landed").where(tx.is_data())
    return rows.groupBy("connector", "tx").agg(F.count("*").alias("n_rows"), F.max("commit_ord").alias("commit_ord"))


@query("gtid_offsets")
def gtid_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return gtid.gtid_offsets(_binlog_with_ids(spark, sf))


@query("gtid_missing")
def gtid_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions of the log that a replica lacks, and whether both make the whole again."""
    log = _binlog_with_ids(spark, sf)
    whole = gtid.gtid_offsets(log).select("connector", gtids.gtid_set(F.col("offset")).alias("a"))
    some = gtid.gtid_sets(_executed(log), ["connector"]).withColumnRenamed("gtids", "b")
    both = whole.join(some, "connector").withColumn("rest", gtids.gtid_subtract(F.col("a"), F.col("b")))
    return both.select(
        "connector", gtids.gtid_text(F.col("rest")).alias("missing"),
        gtids.gtid_subset(F.col("b"), F.col("a")).alias("within"),
        (gtids.gtid_text(gtids.gtid_union(F.col("rest"), F.col("b"))) == gtids.gtid_text(F.col("a"))).alias("whole"),
    )


@query("gtid_resume")
def gtid_resume(spark: SparkSession, sf: str) -> DataFrame:
    """One connector has two stored sets with gaps, the other a file and position only."""
    log = _binlog_with_ids(spark, sf)
    half = (F.floor(F.col("ord") / 80) % 7 < 3).alias("half")
    sets = gtid.gtid_sets(_executed(log).where(F.col("connector") == "my-a").select("connector", half, "gtid"), ["connector", "half"])
    positions_ = log.where((F.col("connector") == "my-b") & (F.floor(F.col("ord") / 80) % 5 == 1) & F.col("event").isin("XID", "QUERY"))
    legacy = positions_.groupBy("connector").agg(F.min_by(F.concat_ws(":", "file", F.col("pos").cast("string")), "ord").alias("offset"))
    stored = sets.select("connector", gtids.gtid_text(F.col("gtids")).alias("offset")).unionByName(legacy)
    return gtid.resume_binlog(log, stored).select("connector", "ord", "event")


@query("db_filter")
def db_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = _binlog_rows(spark, sf, "financeiro").where(tx.is_data())
    return rows.groupBy("connector", "database", "table", "op").agg(F.count("*").alias("n_rows"))


def _redo(spark: SparkSession, sf: str) -> DataFrame:
    return redo_events(fixtures.redo_log(spark, sf))


@query("redo_events")
def redo_framed(spark: SparkSession, sf: str) -> DataFrame:
    return redo_events(fixtures.redo_log(spark, sf), "orclpdb1").select(
        "connector", "database", "schema", "table", "tx", "op", us("ts").alias("ts_us"), "ord", "offset",
        "commit_ord", "commit_offset",
    )


@query("redo_nested")
def redo_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Values that are calls nested one to eight deep."""
    depth = "cast(o_orderkey % 8 + 1 as int)"
    rows = fixtures.table(spark, sf, "orders").selectExpr(
        "o_orderkey as k", f"concat(repeat('F(', {depth}), '\\'it\\'\\'s (\\'', repeat(')', {depth})) as call"
    )
    sql = F.concat(F.lit("insert into ORDERS(K,V) values ("), F.col("k").cast("string"), F.lit(","), "call", F.lit(");"))
    return rows.withColumn("image", parse_insert(sql)).select("k", item("image", "K").alias("key"), item("image", "V").alias("value"))


@query("redo_insert")
def redo_insert(spark: SparkSession, sf: str) -> DataFrame:
    rows = _redo(spark, sf).where((F.col("op") == "INSERT") & F.col("reason").isNull())
    return rows.select(
        "ord", item("after", "O_ORDERKEY").alias("key"), item("after", "O_ORDERSTATUS").alias("status"),
        item("after", "O_DATE").alias("date"), item("after", "O_NOTE").alias("note"), F.size("after").alias("n"),
    )


@query("redo_update")
def redo_update(spark: SparkSession, sf: str) -> DataFrame:
    rows = _redo(spark, sf).where((F.col("op") == "UPDATE") & F.col("reason").isNull())
    return rows.select(
        "ord", item("before", "O_ORDERKEY").alias("key"), item("before", "O_ORDERSTATUS").alias("old_status"),
        item("before", "ROWID").alias("row_id"), F.size("before").alias("n_before"),
        F.map_contains_key("before", "NOTE").alias("has_note"),
        item("after", "O_ORDERSTATUS").alias("new_status"), F.size("after").alias("n_after"),
    )


@query("redo_delete")
def redo_delete(spark: SparkSession, sf: str) -> DataFrame:
    rows = _redo(spark, sf).where((F.col("op") == "DELETE") & F.col("reason").isNull())
    return rows.select(
        "ord", item("before", "O_ORDERKEY").alias("key"), item("before", "O_ORDERSTATUS").alias("status"),
        F.size("before").alias("n"), F.col("after").isNull().alias("no_after"),
    )


@query("redo_literal_text")
def redo_literal_text(spark: SparkSession, sf: str) -> DataFrame:
    """Values as literal text: only the outer quotes are taken off."""
    rows = redo_images(redo_rows(fixtures.redo_log(spark, sf)), literal_parity=True)
    return rows.where(F.col("reason").isNull()).select(
        "ord", "operation", item("after", "O_NOTE").alias("note"),
        F.when(F.col("before").isNotNull(), F.size("before")).alias("n_before"),
    )


@query("raw_sql")
def raw_sql(spark: SparkSession, sf: str) -> DataFrame:
    rows = _redo(spark, sf).where(F.col("reason").isNotNull())
    return rows.select(
        "ord", "op", item("before", "raw_sql").alias("before_raw"), item("after", "raw_sql").alias("after_raw"),
    )


@query("delta")
def delta_images(spark: SparkSession, sf: str) -> DataFrame:
    changed = fixtures.change_rows(spark, sf).where("op = 'UPDATE'").withColumn(
        "d", delta(F.col("before"), F.col("after"))
    )
    return changed.select(
        "connector", "ord", F.size("d").alias("n"), item("d", "cents").alias("cents"), item("d", "props").alias("props"),
        F.map_contains_key("d", "pk").alias("pk_changed"),
    )


@query("event_ids")
def event_ids(spark: SparkSession, sf: str) -> DataFrame:
    return with_event_id(fixtures.change_log(spark, sf)).select("connector", "ord", "op", "event_id")


# --- filters ------------------------------------------------------------------------


@query("owner_filter")
def owner_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.owner_filter(fixtures.redo_log(spark, sf), "fin", 100, "orclpdb1")
    return rows.select("scn", "operation", "tx_name")


def _repeated_redo(spark: SparkSession, sf: str) -> DataFrame:
    redo = fixtures.redo_log(spark, sf)
    again = redo.where(F.col("scn") % 6 == 0).withColumn("ord", F.col("ord") + 1_000_000_000_000)
    return redo.unionByName(again)


@query("dedup_fingerprint")
def dedup_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.dedup_fingerprint(_repeated_redo(spark, sf), order="ord")
    return rows.select("scn", "ord", "operation", "sql_redo")


@query("dlq")
def dlq(spark: SparkSession, sf: str) -> DataFrame:
    _, dead = filters.split_dlq(_redo(spark, sf), F.col("reason"), F.col("sql_redo"))
    return dead


@query("obfuscate")
def obfuscate(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.redo_log(spark, sf).select("scn", obfuscate_sql(F.col("sql_redo")).alias("masked"))


@query("obfuscate_numbers")
def obfuscate_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Statements with numbers, dates, national texts, comments and names that hold digits."""
    stated = fixtures.table(spark, sf, "orders").select("o_orderkey", F.expr(
        r"""concat('insert into T', cast(o_orderkey % 10 as string), '("C 1",SAL2,D) values (', cast(o_custkey as string),
             ', -', cast(o_totalprice as string), ', DATE \'', cast(o_orderdate as string), '\', N\'it\'\'s ', o_orderpriority,
             '\') -- it\'s ', cast(o_orderkey as string), '\n/* ', o_orderstatus, ' */;')"""
    ).alias("sql"))
    return stated.select("o_orderkey", obfuscate_sql(F.col("sql")).alias("masked"))


# --- transactions -------------------------------------------------------------------


@query("commit_gate")
def commit_gate(spark: SparkSession, sf: str) -> DataFrame:
    rows = tx.commit_gate(fixtures.change_log(spark, sf))
    return rows.select(
        "connector", "table", tx_number().alias("tx"), "op", "ord", "commit_ord", us("commit_ts").alias("commit_us"),
        "commit_offset", item("after", "props").alias("props"),
    )


#: The order in which the pieces of a log arrive: one comes late.
ARRIVAL = (0, 1, 3, 2, 4)


def _pieces(rows: DataFrame, piece: str | Column, path: str) -> Callable[[int], DataFrame]:
    """Write rows once in folders by ``piece``; gives the rows of a piece, read from its folder
    only. Rows without a piece are in none."""
    rows.withColumn("__piece", F.col(piece) if isinstance(piece, str) else piece).write.partitionBy("__piece").parquet(path)
    schema = StructType([*rows.schema.fields, StructField("__piece", LongType())])
    split = rows.sparkSession.read.schema(schema).parquet(path)
    return lambda n: split.where(F.col("__piece") == n).drop("__piece")


def _gated(spark: SparkSession, sf: str) -> str:
    """Publish the committed rows of a log that lands in five pieces, out of order, with the
    settings that callers get; the folder of the outputs."""
    base = sinks.scratch_dir(spark, "gate")
    fixtures.change_log(spark, sf).drop("pk").write.parquet(f"{base}/whole")
    whole = spark.read.schema(LOG_SCHEMA).parquet(f"{base}/whole")
    end = (whole.agg(F.max("ord")).first()[0] or 0) + 1
    piece_of = _pieces(whole, F.floor(F.col("ord") * len(ARRIVAL) / end), f"{base}/pieces")
    for piece in ARRIVAL:
        piece_of(piece).write.mode("append").parquet(f"{base}/landed")
        log = logs.stream_change_log(spark, f"{base}/landed", "log")
        gate.publish_committed(log, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return f"{base}/out"


@query("commit_gate_stream")
def commit_gate_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(_gated(spark, sf) + "/committed")
    return rows.select("connector", "table", tx_number().alias("tx"), "op", "ord", "commit_ord")


@query("gate_accounting")
def gate_accounting(spark: SparkSession, sf: str) -> DataFrame:
    """Every data row of a log in pieces, by what the stream gate made of it."""
    out = _gated(spark, sf)
    parts = [
        ("committed", spark.read.parquet(f"{out}/committed")),
        ("waiting", gate.read_waiting(spark, out)),
        ("late", spark.read.schema(LOG_SCHEMA).parquet(f"{out}/late")),
    ]
    rows = reduce(DataFrame.unionAll, [rows.select(F.lit(name).alias("outcome"), "connector", "ord") for name, rows in parts])
    return rows.groupBy("outcome", "connector").agg(F.count("*").alias("n_rows"), F.sum("ord").alias("sum_ord"))


@query("emit_order")
def emit_order(spark: SparkSession, sf: str) -> DataFrame:
    rows = tx.emit_order(fixtures.change_log(spark, sf))
    return rows.select("connector", tx_number().alias("tx"), "commit_ord", "tx_seq", "ord")


@query("tx_cap")
def tx_cap(spark: SparkSession, sf: str) -> DataFrame:
    kept, surplus = tx.cap_transaction(tx.attribute_commits(fixtures.change_log(spark, sf)), 3)
    both = kept.withColumn("kept", F.lit(True)).unionByName(surplus.withColumn("kept", F.lit(False)))
    return both.select("connector", "ord", "tx_seq", "kept")


@query("uncommitted")
def uncommitted(spark: SparkSession, sf: str) -> DataFrame:
    rows = tx.uncommitted(fixtures.change_log(spark, sf))
    return rows.select("connector", tx_number().alias("tx"), "ord", "op")


@query("tx_summary")
def tx_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = tx.tx_summary(fixtures.change_log(spark, sf))
    return summary.select(
        "connector", tx_number().alias("tx"), "commit_ord", "n_rows", F.array_join("tables", ",").alias("tables"),
        "first_ord", "last_ord",
    )


# --- routing and sinks --------------------------------------------------------------


@query("routed")
def routed(spark: SparkSession, sf: str) -> DataFrame:
    return routing.route(fixtures.change_log(spark, sf)).select("topic", "ord", "op")


@query("json_value")
def json_value(spark: SparkSession, sf: str) -> DataFrame:
    return routing.messages(fixtures.change_log(spark, sf)).select("topic", "key", "value")


@query("keyed_messages")
def keyed_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages keyed by the changed row instead of the event id."""
    rows = routing.messages(fixtures.change_log(spark, sf), key="pk", pk=F.col("pk"), keep=("ord",))
    return rows.select("topic", "key", "ord")


@query("lake_sink")
def lake_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Committed rows written as files per topic and read back."""
    base = sinks.scratch_dir(spark, "lake")
    sinks.write_lake(tx.commit_gate(fixtures.change_log(spark, sf)), base)
    back = spark.read.parquet(base)
    return back.groupBy("topic", "op").agg(F.count("*").alias("events"), F.max("ord").alias("last_ord"))


@query("published_batches")
def published_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Stream of committed rows into events, last changes and offsets; the result is the
    current state read from those files."""
    base = sinks.scratch_dir(spark, "publish")
    tx.commit_gate(fixtures.change_log(spark, sf)).write.parquet(f"{base}/committed")
    schema = spark.read.parquet(f"{base}/committed").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/committed")
    sinks.publish_batches(stream, f"{base}/out", f"{base}/checkpoint", pk=["connector", "table", "pk"]).awaitTermination()
    latest = sinks.read_latest(spark, f"{base}/out", ["connector", "table", "pk"])
    return latest.select("connector", "table", "pk", "op", "ord", item("after", "cents").alias("cents"))


# --- offsets ------------------------------------------------------------------------


@query("offset_value")
def offset_value_of_map(spark: SparkSession, sf: str) -> DataFrame:
    log = fixtures.change_rows(spark, sf)
    coordinates = F.when(F.col("ord") % 7 == 0, F.create_map().cast("map<string,string>")).otherwise(
        offset_map(F.col("connector_type"), F.col("offset"))
    )
    return log.select("connector", "ord", offset_value(coordinates).alias("offset"))


@query("offset_key")
def offset_key_order(spark: SparkSession, sf: str) -> DataFrame:
    log = fixtures.change_rows(spark, sf)
    key = offset_key(F.col("connector_type"), F.col("offset"))
    return log.select("connector", "ord", key["file"].alias("file"), key["position"].cast("bigint").alias("position"))


@query("offsets")
def offsets(spark: SparkSession, sf: str) -> DataFrame:
    return positions.latest_offsets(tx.commit_gate(fixtures.change_log(spark, sf)))


@query("resume")
def resume(spark: SparkSession, sf: str) -> DataFrame:
    """Rows from the stored positions on; one connector has none."""
    log = fixtures.change_log(spark, sf)
    stored = log.where((F.col("op") == "COMMIT") & (F.col("ord") % 5 == 1)).groupBy("connector").agg(
        F.min_by("offset", "ord").alias("offset")
    )
    stored = stored.withColumn("offset", F.when(F.col("connector") == "ora-fin", F.lit(" ")).otherwise(F.col("offset")))
    return positions.resume(log, stored).select("connector", "ord", "op")


@query("resume_pruned")
def resume_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """The same from landed files, of which only those are read that reach the positions."""
    base = sinks.scratch_dir(spark, "resume")
    whole = fixtures.change_log(spark, sf).drop("pk")
    whole.repartitionByRange(8, "connector", "ord").write.parquet(base)
    landed = logs.read_change_log(spark, base, "log")
    stored = landed.where((F.col("op") == "COMMIT") & (F.col("ord") % 5 == 1)).groupBy("connector").agg(
        F.min_by("offset", "ord").alias("offset")
    )
    stored = stored.withColumn("offset", F.when(F.col("connector") == "ora-fin", F.lit(" ")).otherwise(F.col("offset")))
    return manifest.resume_files(spark, base, manifest.file_positions(landed), stored).select("connector", "ord", "op")


@query("scn_position")
def scn_position(spark: SparkSession, sf: str) -> DataFrame:
    return positions.scn_position(fixtures.redo_log(spark, sf))


# --- metrics ------------------------------------------------------------------------


@query("events_processed")
def events_processed(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.events_processed(fixtures.change_log(spark, sf))


@query("replication_lag")
def replication_lag(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.replication_lag(fixtures.change_log(spark, sf))


@query("buffer_size")
def buffer_size(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.buffer_size(fixtures.change_log(spark, sf))


@query("buffer_timeline")
def buffer_timeline(spark: SparkSession, sf: str) -> DataFrame:
    rows = metrics.buffer_timeline(fixtures.change_log(spark, sf), "1 hour")
    return rows.select("connector", us("bucket").alias("bucket_us"), "buffered")


@query("connector_status")
def connector_status(spark: SparkSession, sf: str) -> DataFrame:
    """Connectors named after customers; those whose last order is recent are up."""
    known = fixtures.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("name"), F.lit("oracle").alias("type")
    )
    log = fixtures.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("connector"), F.col("o_orderdate").cast("timestamp").alias("ingested_at")
    )
    now = F.expr("timestamp_micros(978307200000000)")
    rows = metrics.connector_status(known, log, now, "400 days")
    return rows.select("connector", "connector_type", us("last_seen").alias("last_seen_us"), "status")


@query("current_position")
def current_position(spark: SparkSession, sf: str) -> DataFrame:
    return positions.current_position(fixtures.change_log(spark, sf))


@query("events_processed_stream")
def events_processed_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per hour as a stream, summed up afterwards."""
    base = sinks.scratch_dir(spark, "counts")
    fixtures.change_log(spark, sf).drop("pk").write.parquet(f"{base}/landed")
    log = logs.stream_change_log(spark, f"{base}/landed", "log")
    counts = metrics.events_processed(log, window="1 hour", lateness="60 days")
    name = f"counts_{base.rsplit('-', 1)[-1].replace('/', '_')}"

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out")

    counts.writeStream.outputMode("complete").foreachBatch(save).queryName(name).option(
        "checkpointLocation", f"{base}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    kept = spark.read.parquet(f"{base}/out")
    return kept.groupBy("connector", "schema", "table", "op").agg(F.sum("events").alias("events"))


def _parts(spark: SparkSession, sf: str, name: str, of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Parts of the change log as it comes in five batches, each with rows of all times."""
    base = sinks.scratch_dir(spark, name)
    log = fixtures.change_log(spark, sf).drop("pk")
    piece_of = _pieces(log, F.pmod(F.hash("ord"), F.lit(STREAM_BATCHES)).cast("bigint"), f"{base}/pieces")
    for piece in range(STREAM_BATCHES):
        piece_of(piece).write.mode("append").parquet(f"{base}/landed")
        stream = logs.stream_change_log(spark, f"{base}/landed", "log")
        rollups.write_parts(stream, {name: of}, f"{base}/parts", f"{base}/checkpoint").awaitTermination()
    return rollups.read_parts(spark, f"{base}/parts", name)


@query("replication_lag_windows")
def replication_lag_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Lag per connector and day, merged from sketches per batch and hour."""
    parts = _parts(spark, sf, "lags", rollups.lag_parts)
    day = F.window("window_start", "1 day")["start"].alias("day")
    return rollups.merge_lags(parts, ["connector", day]).select(
        "connector", us("day").alias("day_us"), "events", "total_ms", "max_ms",
        rollups.lag_quantile(0.5).alias("p50_ms"), rollups.lag_quantile(0.99).alias("p99_ms"),
    )


@query("events_processed_windows")
def events_processed_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per hour from parts of batches, with no state between them."""
    parts = _parts(spark, sf, "counts", rollups.count_parts)
    counts = rollups.merge_counts(parts, ["connector", "schema", "table", "op", "window_start"])
    return counts.withColumn("hour_us", us("window_start")).drop("window_start")


# --- lake ---------------------------------------------------------------------------


@query("dedup_events")
def dedup_events(spark: SparkSession, sf: str) -> DataFrame:
    log = with_event_id(fixtures.change_rows(spark, sf))
    replayed = log.unionByName(log.where(F.col("ord") % 20 == 0))
    return lake.dedup_events(replayed).select("event_id", "connector", "ord")


@query("typed_rows")
def typed_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.change_rows(spark, sf).where("op <> 'DELETE'")
    return lake.typed(rows, {"pk": "bigint", "cents": "int", "props": "int"}, keep=("connector", "ord"))


@query("current_state")
def current_state(spark: SparkSession, sf: str) -> DataFrame:
    rows = tx.commit_gate(fixtures.change_log(spark, sf))
    return lake.current_state(rows, ["connector", "table", "pk"]).select(
        "table", "pk", "op", "connector", "ord", "commit_ord", item("after", "cents").alias("cents"),
        item("after", "props").alias("props"),
    )


@query("current_state_stream")
def current_state_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The state as five batches of committed rows leave it, one of which comes late."""
    base = sinks.scratch_dir(spark, "state")
    tx.commit_gate(fixtures.change_log(spark, sf)).write.parquet(f"{base}/whole")
    whole = spark.read.parquet(f"{base}/whole")
    end = (whole.agg(F.max("ord")).first()[0] or 0) + 1
    for piece in ARRIVAL:
        whole.where(F.floor(F.col("ord") * len(ARRIVAL) / end) == piece).write.mode("append").parquet(f"{base}/landed")
        rows = spark.readStream.schema(whole.schema).parquet(f"{base}/landed")
        state.keep_state(rows, f"{base}/out", f"{base}/checkpoint", ["connector", "table", "pk"], buckets=16).awaitTermination()
    return state.read_state(spark, f"{base}/out").select(
        "table", "pk", "op", "connector", "ord", "commit_ord", item("after", "cents").alias("cents"),
        item("after", "props").alias("props"),
    )


@query("full_after")
def full_after_images(spark: SparkSession, sf: str) -> DataFrame:
    rows = _redo(spark, sf).where((F.col("op") == "UPDATE") & F.col("reason").isNull())
    rows = rows.withColumn("full", full_after(F.col("before"), F.col("after")))
    return rows.select(
        "ord", F.size("full").alias("n"), item("full", "O_ORDERKEY").alias("key"),
        item("full", "O_ORDERSTATUS").alias("status"), item("full", "O_ORDERPRIORITY").alias("priority"),
    )


@query("fill_toast")
def fill_toast(spark: SparkSession, sf: str) -> DataFrame:
    """Every fourth value stays out of line; half of those rows know it from before."""
    hidden = F.col("ord") % 8 == 0
    unknown_before = F.col("ord") % 16 == 0
    put = F.create_map(F.lit("props"), F.lit(TOAST_SENTINEL))
    rows = fixtures.change_rows(spark, sf).where("op <> 'DELETE'").withColumns(
        {
            "after": F.when(hidden, F.map_concat(F.map_filter("after", lambda k, _: k != "props"), put)).otherwise(
                F.col("after")
            ),
            "before": F.when(unknown_before, F.lit(None)).otherwise(F.col("before")),
        }
    )
    filled = lake.fill_toast(rows, ["pk"], ["props"], ["ord", "ordinal"])
    return filled.select("pk", "ord", item("after", "props").alias("props"), item("after", "cents").alias("cents"))


@query("history")
def history(spark: SparkSession, sf: str) -> DataFrame:
    rows = lake.history(tx.commit_gate(fixtures.change_log(spark, sf)), ["connector", "table", "pk"])
    return rows.select("connector", "table", "pk", "commit_ord", "ord", us("valid_from").alias("from_us"), us("valid_to").alias("to_us"))


@query("changed_columns")
def changed_columns(spark: SparkSession, sf: str) -> DataFrame:
    return lake.changed_columns(fixtures.change_rows(spark, sf))


@query("windowed_activity")
def windowed_activity(spark: SparkSession, sf: str) -> DataFrame:
    rows = metrics.windowed_activity(fixtures.change_log(spark, sf), "1 hour")
    return rows.select("connector", "schema", "table", us("window_start").alias("start_us"),
                       us("window_end").alias("end_us"), "events")


@query("event_round_trip")
def event_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Nested event and back; nothing but internal columns is lost."""
    back = from_event(to_event(fixtures.change_log(spark, sf)))
    return back.groupBy("connector", "connector_type", "database", "schema", "table", "op").agg(
        F.count("*").alias("n"), F.count_distinct("event_id").alias("n_ids"), us(F.max("ts")).alias("last_us"),
    )


# --- whole paths --------------------------------------------------------------------


def _published(committed: DataFrame) -> DataFrame:
    return routing.route(committed).groupBy("topic", "op").agg(
        F.count("*").alias("events"), F.min("ord").alias("first_ord"), F.max("commit_ord").alias("last_commit")
    )


@query("postgres_published")
def postgres_published(spark: SparkSession, sf: str) -> DataFrame:
    committed, _, _ = publishable(normalise("postgres", fixtures.pg_log(spark, sf)))
    return _published(committed)


STREAM_BATCHES = 5


def _raw_stream(spark: SparkSession, landed: DataFrame, kind: str, **settings) -> str:
    """Publish a log as a stream that lands piece by piece, each a batch of its own; the
    folder of the outputs."""
    base = sinks.scratch_dir(spark, kind)
    landed.write.parquet(f"{base}/whole")
    whole = spark.read.schema(landed.schema).parquet(f"{base}/whole")
    end = (whole.agg(F.max("ord")).first()[0] or 0) + 1
    piece_of = _pieces(whole, F.floor(F.col("ord") * STREAM_BATCHES / end), f"{base}/pieces")
    for piece in range(STREAM_BATCHES):
        piece_of(piece).write.mode("append").parquet(f"{base}/landed")
        stream = logs.stream_change_log(spark, f"{base}/landed", kind)
        incremental.publish_raw(stream, kind, f"{base}/out", f"{base}/checkpoint", **settings).awaitTermination()
    return f"{base}/out"


@query("postgres_stream")
def postgres_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(_raw_stream(spark, fixtures.pg_log(spark, sf), "postgres") + "/events")
    return rows.groupBy("topic", "op").agg(
        F.count("*").alias("events"), F.min("ord").alias("first_ord"), F.max("commit_ord").alias("last_commit")
    )


@query("mysql_stream")
def mysql_stream(spark: SparkSession, sf: str) -> DataFrame:
    # Stored, as every batch reads it.
    stored = sinks.scratch_dir(spark, "names") + "/names"
    catalogs.column_dictionary(fixtures.column_catalog(spark, sf)).write.parquet(stored)
    names = spark.read.parquet(stored)
    rows = spark.read.parquet(_raw_stream(spark, fixtures.binlog(spark, sf), "mysql", dictionary=names, database="financeiro") + "/events")
    return rows.groupBy("topic", "op").agg(
        F.count("*").alias("events"), F.min("ord").alias("first_ord"), F.max("commit_ord").alias("last_commit")
    )


@query("stream_accounting")
def stream_accounting(spark: SparkSession, sf: str) -> DataFrame:
    """Every data row of a log that came in pieces, by what became of it. Rows still pending
    after the last piece count as what they are by then."""
    out = _raw_stream(spark, fixtures.pg_log(spark, sf), "postgres")
    _, waiting, dead = publishable(normalise("postgres", spark.read.parquet(f"{out}/pending/batch={STREAM_BATCHES - 1}")))
    parts = [
        ("published", spark.read.parquet(f"{out}/events")),
        ("dead letter", spark.read.parquet(f"{out}/dead_letters")), ("dead letter", dead),
        ("waiting", spark.read.parquet(f"{out}/abandoned")), ("waiting", waiting),
        ("late", spark.read.parquet(f"{out}/late")),
    ]
    rows = reduce(DataFrame.unionAll, [rows.select(F.lit(name).alias("outcome"), "connector", "ord") for name, rows in parts])
    return rows.groupBy("outcome", "connector").agg(F.count("*").alias("n_rows"), F.sum("ord").alias("sum_ord"))


@query("mysql_published")
def mysql_published(spark: SparkSession, sf: str) -> DataFrame:
    names = catalogs.column_dictionary(fixtures.column_catalog(spark, sf))
    rows = normalise("mysql", fixtures.binlog(spark, sf), dictionary=names, database="financeiro")
    return _published(publishable(rows)[0])


@query("oracle_published")
def oracle_published(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalise("oracle", _repeated_redo(spark, sf), owner="FIN", start=100, container="ORCLPDB1")
    return _published(publishable(rows)[0])


def _mined(spark: SparkSession, sf: str) -> str:
    """Publish redo records as a stream. Each piece begins with the last position of the one
    before, as mining does that goes on from there; after the last, the first comes again."""
    base = sinks.scratch_dir(spark, "redo")
    columns = [c.split()[0] for c in logs.LANDED_SCHEMAS["oracle"].split(", ")]
    log = _repeated_redo(spark, sf).select(*columns)
    end = (log.agg(F.max("scn")).first()[0] or 0) + 1
    piece = F.floor(F.col("scn") * STREAM_BATCHES / end)
    last = [r["scn"] for r in log.groupBy(piece.alias("piece")).agg(F.max("scn").alias("scn")).collect()]
    # The rows of a piece's last position are in the next piece, too.
    placed = log.withColumn("__n", F.explode(F.when(F.col("scn").isin(last), F.array(piece, piece + 1)).otherwise(F.array(piece))))
    piece_of = _pieces(placed, "__n", f"{base}/pieces")
    for n in [*range(STREAM_BATCHES), 0]:
        piece_of(n).select(*columns).write.mode("append").parquet(f"{base}/landed")
        stream = logs.stream_change_log(spark, f"{base}/landed", "oracle")
        incremental.publish_redo(stream, f"{base}/out", f"{base}/checkpoint", "FIN", 100, "ORCLPDB1").awaitTermination()
    return f"{base}/out"


@query("oracle_stream")
def oracle_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(_mined(spark, sf) + "/events")
    return rows.groupBy("topic", "op").agg(
        F.count("*").alias("events"), F.min("ord").alias("first_ord"), F.max("commit_ord").alias("last_commit")
    )


@query("oracle_accounting")
def oracle_accounting(spark: SparkSession, sf: str) -> DataFrame:
    """Every statement of a redo stream, by what became of it; late ones are those sent again."""
    out = _mined(spark, sf)
    schema = logs.LANDED_SCHEMAS["oracle"]
    late = spark.read.schema(schema).parquet(f"{out}/late").select("connector", "scn").distinct()
    parts = [
        ("published", spark.read.parquet(f"{out}/events").select("connector", "ord")),
        ("dead letter", spark.read.parquet(f"{out}/dead_letters").select("connector", "ord")),
        ("late", late),
    ]
    rows = reduce(DataFrame.unionAll, [rows.select(F.lit(name).alias("outcome"), *rows.columns).toDF("outcome", "connector", "ord") for name, rows in parts])
    return rows.groupBy("outcome", "connector").agg(F.count("*").alias("n_rows"), F.sum("ord").alias("sum_ord"))
