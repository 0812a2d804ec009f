"""Change logs derived from the given tables: decoded, redo text, binlog and message
bytes. They stand in for landed logs; their size grows with the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.schema import CONTROL_SCHEMA, CONTROL_TABLE, LOG_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Times in the tables have no zone; they are read as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A landed log lies in many files. A table in fewer files than there are cores is
    spread over them; larger ones are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_OFFSET = """case connector_type
    when 'postgres' then concat(hex(ord div 4294967296), '/', hex(ord % 4294967296))
    when 'mysql' then concat('mysql-bin.', lpad(cast(ord div 100000 as string), 6, '0'), ':', cast(ord % 100000 as string))
    else cast(ord as string) end"""


def change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data rows of the decoded log: three connectors, four tables, interleaved
    transactions of up to eight rows. ``pk`` is the changed row's key."""
    rows = spark.sql(
        """
        select
          case event_id % 3 when 0 then 'pg-fin' when 1 then 'my-fin' else 'ora-fin' end as connector,
          case event_id % 3 when 0 then 'postgres' when 1 then 'mysql' else 'oracle' end as connector_type,
          'fin' as database, 'public' as schema, concat('t', cast(user_id % 4 as string)) as table,
          cast(cast(floor(event_id / 24) as bigint) * 2 + user_id % 2 as string) as tx,
          case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end as op,
          cast(ts as timestamp) as ts, event_id * 2 as ord, 0 as ordinal,
          case when event_type <> 'signup' then map('pk', cast(user_id as string),
               'cents', cast(event_id % 50 as string),
               'props', concat('{{"k": ', cast(event_id % 100 as string), '}}')) end as before,
          case when event_type <> 'error' then map('pk', cast(user_id as string),
               'cents', cast(cast(floor(value * 100) as bigint) as string), 'props', props) end as after,
          cast(ts as timestamp) + make_interval(0, 0, 0, 0, 0, 0, event_id % 7 - 1) as ingested_at,
          user_id as pk
        from {events}
        """,
        events=spread(table(spark, sf_dir, "events")),
    )
    return rows.withColumn("offset", F.expr(_OFFSET))


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log frame of the data rows and their commits; every fifth transaction stays open."""
    rows = change_rows(spark, sf_dir)
    commits = (
        rows.where(F.col("tx").cast("bigint") % 5 != 0)
        .groupBy("connector", "connector_type", "database", "tx")
        .agg((F.max("ord") + 1).alias("ord"), F.max("ts").alias("ts"), F.max("ingested_at").alias("ingested_at"))
        .withColumns(
            {
                "schema": F.lit(CONTROL_SCHEMA),
                "table": F.lit(CONTROL_TABLE),
                "op": F.lit("COMMIT"),
                "ordinal": F.lit(0),
                "offset": F.expr(_OFFSET),
            }
        )
    )
    return rows.unionByName(commits, allowMissingColumns=True).select(*LOG_COLUMNS, "pk")


def redo_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mined redo records; every 25th statement is one no parser understands."""
    return spark.sql(
        """
        select 'ora-fin' as connector, o_orderkey as ord, o_orderkey as scn, 'FIN' as seg_owner,
          case o_orderkey % 2 when 0 then 'ORCLPDB1' else 'OTHERPDB' end as src_con_name,
          'ORDERS' as table_name,
          case when o_orderkey % 5 = 0 then null else concat('tx', cast(o_orderkey as string)) end as tx_name,
          cast(o_orderdate as timestamp) as timestamp, cast(o_orderdate as timestamp) as ingested_at,
          case o_orderkey % 4 when 0 then 'INSERT' when 1 then 'UPDATE' when 2 then 'DELETE' else 'DDL' end as operation,
          case when o_orderkey % 25 = 24 then concat('merge into x using y on ''', o_orderstatus, '''')
          else case o_orderkey % 4
            when 0 then concat('insert into "FIN"."ORDERS"("O_ORDERKEY","O_ORDERSTATUS","O_DATE","O_NOTE") values (''',
              cast(o_orderkey as string), ''',''', o_orderstatus, ''',TO_DATE(''2024-01-01'', ''YYYY-MM-DD''),''it''''s, (', o_orderpriority, ')'');')
            when 1 then concat('update "FIN"."ORDERS" set "O_ORDERSTATUS" = ''F'', "O_ORDERPRIORITY" = ''', o_orderpriority,
              ''' where "O_ORDERKEY" = ''', cast(o_orderkey as string), ''' and "O_ORDERSTATUS" = ''', o_orderstatus,
              ''' and "O_ORDERPRIORITY" = ''', o_orderpriority, ''' and "NOTE" IS NULL and ROWID = ''AAA', cast(o_orderkey as string), ''';')
            when 2 then concat('delete from "FIN"."ORDERS" where "O_ORDERKEY" = ''', cast(o_orderkey as string),
              ''' and "O_ORDERSTATUS" = ''', o_orderstatus, ''';')
            else 'alter table' end
          end as sql_redo
        from {orders}
        """,
        orders=spread(table(spark, sf_dir, "orders")),
    )


def binlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binlog events of two connectors: up to three rows per row event, four row events per
    transaction, table ids bound to new tables as the log goes on, one id never bound."""
    orders = table(spark, sf_dir, "orders")
    groups = spark.sql(
        """
        select cast(floor(o_orderkey / 3) as bigint) as g, max(cast(o_orderdate as timestamp)) as header_ts,
          transform(array_sort(collect_list(struct(o_orderkey as k,
             array(cast(o_custkey as string), o_orderstatus, o_orderpriority) as v,
             array(cast(o_custkey + 1 as string), null, o_orderpriority) as w))),
             r -> struct(r.v as v, r.w as w)) as r
        from {orders} group by 1
        """,
        orders=orders,
    )
    own = "case when cast(floor(g / 4) as bigint) % 2 = 0 then 'my-a' else 'my-b' end"
    era = "cast(floor(g / 70) as bigint)"
    row_event = """case g % 3 when 0 then 'WRITE' when 1 then 'UPDATE' else 'DELETE' end"""
    images = """transform(r, x -> struct(case g % 3 when 0 then null when 1 then x.w else x.v end as before,
                                         case g % 3 when 2 then null else x.v end as after))"""

    def entry(keep: str, connector: str, place: int, event: str, table_id: str = "null", db: str = "null",
              tbl: str = "null", sql: str = "null", rows: str = "null") -> str:
        return f"""case when {keep} then named_struct('connector', {connector}, 'ord', g * 10 + {place},
            'event', {event}, 'table_id', cast({table_id} as bigint), 'db', cast({db} as string),
            'table', cast({tbl} as string), 'sql', cast({sql} as string), 'rows', cast({rows} as
            array<struct<before: array<string>, after: array<string>>>)) end"""

    name = f"concat('orders_', cast({era} % 2 as string))"
    entries = [
        entry("true", own, 5, row_event, "case when g % 11 = 10 then 3L else g % 2 + 1 end", rows=images),
        entry("g % 4 = 3", own, 9, "case when g % 16 = 15 then 'QUERY' else 'XID' end",
              sql="case when g % 16 = 15 then ' commit ' end"),
    ]
    for connector in ("'my-a'", "'my-b'"):
        entries.append(entry("g % 70 = 0", connector, 1, "'TABLE_MAP'", "1", "'financeiro'", name))
        db = f"case when {era} % 3 <> 0 then 'financeiro' else 'other' end"
        entries.append(entry("g % 70 = 0", connector, 2, "'TABLE_MAP'", "2", db, name))
    return spark.sql(
        f"""
        select e.connector, 1L as server_id, e.ord, 'mysql-bin.000001' as file, e.ord * 100 as pos, e.event,
          header_ts, e.table_id, e.db, e.table, e.sql, e.rows, header_ts as ingested_at
        from (select header_ts, explode(filter(array({", ".join(entries)}), x -> x is not null)) as e from {{groups}})
        """,
        groups=groups,
    )


def column_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows of the binlog's tables, unordered; the third value has no name."""
    return spark.sql(
        """
        select 'financeiro' as schema, concat('orders_', cast(o_orderkey % 2 as string)) as table,
          case o_orderkey % 3 when 0 then 'o_status' else 'o_cust' end as column,
          case o_orderkey % 3 when 0 then 2 else 1 end as position
        from {orders} order by o_orderstatus
        """,
        orders=table(spark, sf_dir, "orders"),
    )


def _u32(value: str) -> str:
    return f"unhex(lpad(hex(cast({value} as bigint)), 8, '0'))"


def _u64(value: str) -> str:
    return f"unhex(lpad(hex(cast({value} as bigint)), 16, '0'))"


def _text(value: str) -> str:
    return f"concat(X'74', {_u32(f'octet_length({value})')}, encode({value}, 'UTF-8'))"


def _tuple(*columns: str) -> str:
    return f"concat(unhex('{len(columns):04X}'), {', '.join(columns)})"


def pg_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message bytes of two connectors: eight rows per transaction, every fifth one open;
    one relation redefined as the log goes on, one defined late; inserts, updates with and
    without old tuple, deletes, nulls and unchanged out-of-line values."""
    orders = spark.sql(
        """
        select o_orderkey as k, cast(floor(o_orderkey / 8) as bigint) as t, cast(o_orderkey as string) as id,
          o_orderstatus as status, concat(o_orderpriority, ' ção') as note,
          unix_micros(cast(o_orderdate as timestamp)) - 946684800000000 as us,
          cast(o_orderdate as timestamp) as ingested_at
        from {orders}
        """,
        orders=spread(table(spark, sf_dir, "orders")),
    )
    connector = "case when t % 2 = 0 then 'pg-a' else 'pg-b' end"
    relation = "case when k % 3 = 1 then 16386 else 16385 end"
    null, toast = "X'6E'", "X'75'"
    new = _tuple(_text("id"), _text("status"), f"case when k % 4 = 0 then {null} else {toast} end")
    old = _tuple(_text("id"), null, _text("note"))
    surplus = _tuple(_text("id"), _text("status"), null, _text("note"))

    def entry(place: int, payload: str, keep: str, con: str = connector) -> str:
        return (
            f"case when {keep} then named_struct('connector', {con}, 'ord', k * 10 + {place}, "
            f"'payload', {payload}) end"
        )

    def relation_message(rel: int, table_name: str, second: str) -> str:
        def column(name: str) -> str:
            return f"concat(X'00', encode({name}, 'UTF-8'), X'0000000019FFFFFFFF')"

        return (
            f"concat(X'52', {_u32(str(rel))}, encode('public', 'UTF-8'), X'00', encode('{table_name}', 'UTF-8'), "
            f"X'00', X'64', X'0003', {column(chr(39) + 'o_orderkey' + chr(39))}, {column(second)}, "
            f"{column(chr(39) + 'o_anotação' + chr(39))})"
        )

    version = "concat('status_', cast(cast(floor(k / 1000) as bigint) as string))"
    entries = [
        entry(0, f"concat(X'42', X'0000000000000000', {_u64('us')}, {_u32('t')})", "k % 8 = 0"),
        entry(3, "concat(X'4F', encode('origin', 'UTF-8'))", "k % 50 = 0"),
        entry(5, f"concat(X'49', {_u32(relation)}, X'4E', case when k % 40 = 20 then {surplus} else {new} end)",
              "k % 4 = 0"),
        entry(5, f"concat(X'55', {_u32(relation)}, case when k % 12 = 5 then X'4E' when k % 8 = 1 then "
                 f"concat(X'4F', {old}, X'4E') else concat(X'4B', {old}, X'4E') end, {new})", "k % 4 in (1, 2)"),
        entry(5, f"concat(X'44', {_u32(relation)}, X'4F', {old})", "k % 4 = 3 and k % 100 <> 99"),
        # Broken: an unknown column kind.
        entry(5, f"concat(X'44', {_u32(relation)}, X'4F', X'0001', X'7A')", "k % 100 = 99"),
        entry(9, f"concat(X'43', X'00', X'0000000000000000', X'0000000000000000', {_u64('us')})",
              "k % 8 = 7 and t % 5 <> 0"),
    ]
    for con in ("'pg-a'", "'pg-b'"):
        entries.append(entry(1, relation_message(16385, "orders", version), "k % 1000 = 0", con))
        entries.append(entry(2, relation_message(16386, "outras", "'status'"), "k = 10", con))
    return spark.sql(
        f"""
        select e.connector, 'fin' as database, e.ord,
          concat(hex(e.ord div 4294967296), '/', hex(e.ord % 4294967296)) as offset, e.payload, ingested_at
        from (select ingested_at, explode(filter(array({", ".join(entries)}), x -> x is not null)) as e from {{orders}})
        """,
        orders=orders,
    )
