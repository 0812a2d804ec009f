"""Plain SQL for the registered queries, over the same tables.

Each statement computes its result from the base tables and the rule the fixture was
made by, not by decoding, so it checks the decoders too.
"""

from __future__ import annotations


def _offset(ord_: str) -> str:
    return f"""case connector_type
        when 'postgres' then hex({ord_} // 4294967296) || '/' || hex({ord_} % 4294967296)
        when 'mysql' then 'mysql-bin.' || lpad(cast({ord_} // 100000 as varchar), 6, '0') || ':' || cast({ord_} % 100000 as varchar)
        else cast({ord_} as varchar) end"""


_CHLOG = f"""
rows0 as (
  select event_id * 2 as ord, ts, user_id as pk,
    case event_id % 3 when 0 then 'pg-fin' when 1 then 'my-fin' else 'ora-fin' end as connector,
    case event_id % 3 when 0 then 'postgres' when 1 then 'mysql' else 'oracle' end as connector_type,
    't' || cast(user_id % 4 as varchar) as tbl,
    (event_id // 24) * 2 + user_id % 2 as tx,
    case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end as op,
    cast(event_id % 50 as varchar) as cents0, '{{"k": ' || cast(event_id % 100 as varchar) || '}}' as props0,
    cast(cast(floor(value * 100) as bigint) as varchar) as cents1, props as props1,
    ts + to_seconds(event_id % 7 - 1) as ingested_at
  from events),
chlog as (
  select * exclude (cents0, props0, cents1, props1), {_offset('ord')} as off,
    case when op <> 'INSERT' then cents0 end as old_cents, case when op <> 'INSERT' then props0 end as old_props,
    case when op <> 'DELETE' then cents1 end as new_cents, case when op <> 'DELETE' then props1 end as new_props
  from rows0),
commits as (
  select connector, connector_type, tx, max(ord) + 1 as commit_ord, max(ts) as commit_ts, max(ingested_at) as ingested_at
  from chlog where tx % 5 <> 0 group by all),
attributed as (
  select c.*, m.commit_ord, m.commit_ts from chlog c left join commits m using (connector, tx)),
committed as (select * from attributed where commit_ord is not null),
everything as (
  select connector, connector_type, 'public' as sch, tbl, tx, op, ts, ord, off, ingested_at from chlog
  union all
  select connector, connector_type, 'system', 'transaction', tx, 'COMMIT', commit_ts, commit_ord, {_offset('commit_ord')}, ingested_at
  from commits)
"""


def _id(ord_: str = "ord", off: str = "off") -> str:
    digest = f"md5(connector || '|' || {off} || '|' || cast({ord_} as varchar) || '|0')"
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({digest}, {a}, {n})" for a, n in cuts)


def _chlog(select: str) -> str:
    return f"with {_CHLOG} {select}"


_REDO = """
redo as (
 select o_orderkey as k, o_orderkey as scn, o_orderdate, o_orderstatus, o_orderpriority,
  case o_orderkey % 2 when 0 then 'ORCLPDB1' else 'OTHERPDB' end as con,
  case when o_orderkey % 5 = 0 then null else concat('tx', cast(o_orderkey as varchar)) end as tx_name,
  case o_orderkey % 4 when 0 then 'INSERT' when 1 then 'UPDATE' when 2 then 'DELETE' else 'DDL' end as op,
  o_orderkey % 25 <> 24 as good,
  case when o_orderkey % 25 = 24 then concat('merge into x using y on ''', o_orderstatus, '''')
  else case o_orderkey % 4
    when 0 then concat('insert into "FIN"."ORDERS"("O_ORDERKEY","O_ORDERSTATUS","O_DATE","O_NOTE") values (''',
      cast(o_orderkey as varchar), ''',''', o_orderstatus, ''',TO_DATE(''2024-01-01'', ''YYYY-MM-DD''),''it''''s, (', o_orderpriority, ')'');')
    when 1 then concat('update "FIN"."ORDERS" set "O_ORDERSTATUS" = ''F'', "O_ORDERPRIORITY" = ''', o_orderpriority,
      ''' where "O_ORDERKEY" = ''', cast(o_orderkey as varchar), ''' and "O_ORDERSTATUS" = ''', o_orderstatus,
      ''' and "O_ORDERPRIORITY" = ''', o_orderpriority, ''' and "NOTE" IS NULL and ROWID = ''AAA', cast(o_orderkey as varchar), ''';')
    when 2 then concat('delete from "FIN"."ORDERS" where "O_ORDERKEY" = ''', cast(o_orderkey as varchar),
      ''' and "O_ORDERSTATUS" = ''', o_orderstatus, ''';')
    else 'alter table' end
  end as sql_redo
 from orders)
"""


def _redo(select: str) -> str:
    return f"with {_REDO} {select}"


_PG = """
base as (
 select o_orderkey as k, o_orderkey // 8 as t, cast(o_orderkey as varchar) as id, o_orderstatus as status,
  o_orderpriority || ' ção' as note, o_orderdate, max(o_orderkey) over () as max_k,
  case when (o_orderkey // 8) % 2 = 0 then 'pg-a' else 'pg-b' end as connector
 from orders),
closing as (
 select t, k * 10 + 9 as commit_ord, o_orderdate as commit_ts from base where k % 8 = 7 and t % 5 <> 0),
pg as (
 select b.*, b.k * 10 + 5 as ord, c.commit_ord, c.commit_ts,
  hex(c.commit_ord // 4294967296) || '/' || hex(c.commit_ord % 4294967296) as commit_offset,
  case b.k % 4 when 0 then 'INSERT' when 3 then 'DELETE' else 'UPDATE' end as op,
  case when b.k % 3 = 1 then 'outras' else 'orders' end as tbl,
  case when b.k % 3 = 1 then 'status' else 'status_' || cast(b.k // 1000 as varchar) end as status_name,
  case when b.k % 3 = 1 and b.k < 10 then 'relation unknown' when b.k % 100 = 99 then 'tuple malformed' end as reason,
  b.k % 4 = 3 or (b.k % 4 in (1, 2) and b.k % 12 <> 5) as has_old
 from base b left join closing c using (t))
"""


def _pg(select: str) -> str:
    return f"with {_PG} {select}"


_BINLOG = """
base as (
 select o_orderkey as k, o_orderkey // 3 as g, o_orderkey % 3 as ordinal, cast(o_custkey as varchar) as cust,
  cast(o_custkey + 1 as varchar) as cust1, o_orderstatus as status, o_orderpriority as prio,
  max(o_orderdate) over (partition by o_orderkey // 3) as header_ts
 from orders),
closing as (
 select distinct g // 4 as b, g * 10 + 9 as commit_ord, header_ts as commit_ts from base where g % 4 = 3),
bl0 as (
 select *, g * 10 + 5 as ord, g // 70 as era, case when (g // 4) % 2 = 0 then 'my-a' else 'my-b' end as connector,
  case when g % 11 = 10 then 3 else g % 2 + 1 end as table_id,
  case g % 3 when 0 then 'INSERT' when 1 then 'UPDATE' else 'DELETE' end as op
 from base),
bl as (
 select b.*, c.commit_ord, c.commit_ts, b.g // 8 as tx,
  case when table_id < 3 then case when table_id = 1 or era % 3 <> 0 then 'financeiro' else 'other' end end as db,
  case when table_id < 3 then 'orders_' || cast(era % 2 as varchar) end as tbl
 from bl0 b left join closing c on c.b = b.g // 4)
"""


def _binlog(select: str) -> str:
    return f"with {_BINLOG} {select}"


_GTIDS = """
named as (
  select *, g // 8 + 1 as gno, case when (g // 8) // 50 % 2 = 0 then '0a000000-0000-0000-0000-00000000000a'
    else '0b000000-0000-0000-0000-00000000000b' end as server from bl),
commits as (select distinct connector, server, gno from named where g % 4 = 3),
runs as (
  select connector, server, min(gno) as lo, max(gno) as hi from (
    select *, gno - row_number() over (partition by connector, server order by gno) as island from commits)
  group by connector, server, island),
servers as (
  select connector, server, string_agg(case when lo = hi then cast(lo as varchar)
    else cast(lo as varchar) || '-' || cast(hi as varchar) end, ':' order by lo) as numbers from runs group by all),
whole as (select connector, string_agg(server || ':' || numbers, ',' order by server) as text from servers group by connector)
"""


def _gtids(select: str) -> str:
    return f"with {_BINLOG}, {_GTIDS} {select}"


_ISO = """strftime(ts, '%Y-%m-%dT%H:%M:%S') || case
    when epoch_us(ts) % 1000000 = 0 then ''
    when epoch_us(ts) % 1000 = 0 then '.' || lpad(cast(epoch_us(ts) % 1000000 // 1000 as varchar), 3, '0')
    else '.' || lpad(cast(epoch_us(ts) % 1000000 as varchar), 6, '0') end || 'Z'"""


def _image_json(cents: str, props: str) -> str:
    return (
        f"case when {cents} is null then 'null' else '{{\"pk\":\"' || cast(pk as varchar) || '\",\"cents\":\"' || {cents} "
        f"|| '\",\"props\":\"' || replace({props}, '\"', '\\\"') || '\"}}' end"
    )


_JSON = f"""'{{"eventId":"' || {_id()} || '","operation":"' || op || '","timestamp":"' || {_ISO}
  || '","source":{{"connectorName":"' || connector || '","connectorType":"' || connector_type
  || '","database":"fin","schema":"public","table":"' || tbl || '","transactionId":"' || cast(tx as varchar)
  || '","offsetCoordinates":{{"' || case connector_type when 'postgres' then 'lsn' when 'mysql' then 'binlog_pos' else 'scn' end
  || '":"' || off || '"}}}},"before":' || {_image_json('old_cents', 'old_props')}
  || ',"after":' || {_image_json('new_cents', 'new_props')} || '}}'"""

_EVENTS = f"""select {_id()} as event_id, connector, connector_type, 'public' as "schema", tbl as "table", tx, op,
  epoch_us(ts) as ts_us, off as "offset", old_cents, new_cents, new_props from chlog"""

_STATE = """(select *, row_number() over (partition by connector, tbl, pk order by commit_ord desc, ord desc) as rn from committed)"""

_SNAPSHOT = """
select 'BEGIN' as op, 'system' as "schema", 'transaction' as "table", 'snapshot-tx' as tx,
  -4611686018427387905 as ord, cast(0 as integer) as ordinal, 'mysql-bin.000002:154' as "offset", 1704067200000000 as ts_us,
  null::varchar as id, null::varchar as name, null::varchar as nation
union all
select 'COMMIT', 'system', 'transaction', 'snapshot-tx', -1, 0, 'mysql-bin.000002:154', 1704067200000000, null, null, null
union all
select 'READ', 'fin', 'customer', 'snapshot-tx', c_custkey - 4611686018427387904, 0, 'mysql-bin.000002:154', 1704067200000000,
  cast(c_custkey as varchar), c_name, cast(c_nationkey as varchar) from customer
union all
select 'READ', 'fin', 'nation', 'snapshot-tx', n_nationkey - 4611686018427387904, 1, 'mysql-bin.000002:154', 1704067200000000,
  cast(n_nationkey as varchar), n_name, null from nation
"""

_GATE = """select connector, tbl as "table", tx, op, ord, commit_ord from committed"""

ORACLES: dict[str, str] = {
    "committed_by_topic": _chlog(
        "select 'cdc.' || connector || '.public.' || tbl as topic, op, count(*) as events from committed group by all"
    ),
    # sources
    "connectors": """
select case when s_suppkey % 10 <> 7 then 'c' || cast(s_suppkey as varchar) end as name,
  case when s_suppkey % 10 = 8 then 'mysql' when s_suppkey % 10 <> 7 then
    case s_suppkey % 3 when 0 then 'postgres' when 1 then 'mysql' else 'oracle' end end as type,
  case when s_suppkey % 10 not in (7, 8) then cast(3000 + s_suppkey as varchar) end as port,
  case when s_suppkey % 10 not in (7, 8) then '****' end as password,
  case when s_suppkey % 10 not in (7, 8) then 'fin' end as database,
  case s_suppkey % 10 when 7 then 'not JSON' when 8 then 'config missing' end as error
from supplier""",
    "snapshot_events": _SNAPSHOT,
    "snapshot_counts": """
select 'my-fin' as connector, 'fin' as "schema", 'customer' as "table", count(*) as n_rows from customer
union all select 'my-fin', 'fin', 'nation', count(*) from nation""",
    "snapshot_needed": """
select 'c' || cast(c_custkey as varchar) as name, 'postgres' as type from customer
where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')""",
    "snapshot_then_log": _chlog(
        f"""select op, tbl as "table", count(*) as n_rows, min(ord) as first_ord from (
          select op, "table" as tbl, ord from ({_SNAPSHOT}) s
          union all
          select op, tbl, ord from everything where connector = 'my-fin' and ord > 1540) group by all"""
    ),
    "read_events_json": _chlog(_EVENTS),
    "stream_events": _chlog(_EVENTS),
    "scope_filter": _chlog("""select connector, tbl as "table", ord, op from chlog where tbl <> 't3'"""),
    "column_dictionary": """
select distinct 'financeiro' as "schema", 'orders_' || cast(o_orderkey % 2 as varchar) as "table", 'o_cust,o_status' as names
from orders""",
    "prune_segments": """
select distinct name from (
  select '/arc/1_' || cast(event_id as varchar) as name from events
  where event_type <> 'view' and (event_id + 1) * 10 >= 5000 and event_id % 7 <> 0
  union all
  select '/redo/a_' || cast(event_id as varchar) from events
  where event_type = 'view' and event_id % 3 in (0, 1) and event_id % 50 <> 0)""",
    "safe_start": """
select coalesce(min(event_id * 10 + 5), 0) as start from events where event_type = 'view' and event_id % 3 in (0, 1)""",
    # normalise
    "pg_decode": _pg("""
select connector, ord, op, 'public' as "schema", tbl as "table", cast(t as varchar) as tx, commit_ord,
  case when has_old then id end as old_key, case when has_old then note end as old_note,
  case when op <> 'DELETE' then id end as new_key,
  case when op = 'UPDATE' then '__TOASTED_VALUE__' end as new_note,
  case when k % 40 = 20 then note end as surplus,
  cast(case op when 'DELETE' then 0 else case when k % 40 = 20 then 4 else 3 end end as integer) as n_after,
  case when op = 'DELETE' then '' else status_name end as status_name
from pg where reason is null"""),
    "relation_asof": _pg("""
select connector, case when coalesce(reason, '') <> 'relation unknown' then tbl end as "table", reason,
  case reason when 'relation unknown' then '' when 'tuple malformed' then null else status_name end as status_name,
  count(*) as n_rows from pg group by all"""),
    "tx_interval": _pg("""
select connector, t as tx, count(*) as n_rows, max(commit_ord) as commit_ord, epoch_us(max(commit_ts)) as commit_us,
  max(commit_offset) as commit_offset from pg group by all"""),
    "pg_ts": _pg("""
select connector, k * 10 as ord, 'B' as type, t as xid, epoch_us(o_orderdate) as ts_us from base where k % 8 = 0
union all
select connector, k * 10 + 9, 'C', null, epoch_us(o_orderdate) from base where k % 8 = 7 and t % 5 <> 0"""),
    "name_columns": """
select o_orderkey, cast(o_orderkey % 4 as integer) as n,
  case when o_orderkey % 4 >= 1 then cast(o_custkey as varchar) end as cust,
  case when o_orderkey % 4 >= 2 then o_orderstatus end as status,
  case when o_orderkey % 4 >= 3 then o_orderpriority end as col_2
from orders""",
    "binlog_rows": _binlog("""
select connector, ord, cast(ordinal as integer) as ordinal, op, db as database, tbl as "table",
  case op when 'UPDATE' then cust1 when 'DELETE' then cust end as old_cust,
  case op when 'DELETE' then status end as old_status,
  case when op <> 'DELETE' then cust end as new_cust, case when op <> 'DELETE' then status end as new_status,
  case when op <> 'DELETE' then prio end as new_col_2, db = 'financeiro' as named
from bl where db is not null"""),
    "table_map_asof": _binlog("""
select connector, cast(table_id as bigint) as table_id, db, tbl as "table", count(distinct g) as n_events
from bl group by all"""),
    "binlog_tx": _binlog("""
select connector, tx, count(*) as n_rows, max(commit_ord) as commit_ord,
  'mysql-bin.000001:' || cast(max(commit_ord) * 100 as varchar) as commit_offset, epoch_us(max(commit_ts)) as commit_us
from bl where db is not null group by all"""),
    "binlog_tx_header": _binlog("""
, marks as (
  select distinct connector, 'tx-1-' || cast(epoch_ms(header_ts) as varchar) as tx, g * 10 + 9 as commit_ord
  from bl where g % 4 = 3),
waiting as (
  select connector, 'tx-1-' || cast(epoch_ms(header_ts) as varchar) as tx, ord, cast(ordinal as integer) as ordinal
  from bl where db = 'financeiro')
select w.connector, w.tx, w.ord, w.ordinal, min(m.commit_ord) as commit_ord
from waiting w left join marks m on m.connector = w.connector and m.tx = w.tx and m.commit_ord >= w.ord
group by all"""),
    "binlog_tx_gtid": _gtids("""
select connector, server || ':' || cast(gno as varchar) as tx, count(*) as n_rows, max(commit_ord) as commit_ord
from named where db is not null group by all"""),
    "gtid_offsets": _gtids("""
select connector, 'mysql' as connector_type, text as "offset" from whole"""),
    "gtid_missing": _gtids("""
select connector, string_agg(server || ':' || numbers, ',' order by server) as missing, true as within, true as whole from (
  select connector, server, string_agg(cast(gno as varchar), ':' order by gno) as numbers
  from commits where gno % 7 = 0 group by all) group by connector"""),
    "gtid_resume": _gtids("""
, log as (
  select distinct connector, ord, case op when 'INSERT' then 'WRITE' else op end as event, g // 8 as n from bl
  union all
  select distinct connector, g * 10 + 9, case when g % 16 = 15 then 'QUERY' else 'XID' end, g // 8 from bl where g % 4 = 3
  union all
  select distinct c, g * 10 + place, 'TABLE_MAP', null
  from bl, (values ('my-a'), ('my-b')) as a(c), (values (1), (2)) as b(place) where g % 70 = 0),
start as (select min(g * 10 + 9) as first from bl where connector = 'my-b' and g % 4 = 3 and (g // 8) % 5 = 1)
select l.connector, l.ord, l.event from log l, start s left join commits m on m.connector = l.connector and m.gno = l.n + 1
where case when l.connector = 'my-b' then l.ord >= s.first else l.n is null or m.gno is null or m.gno % 7 = 0 end"""),
    "db_filter": _binlog("""
select connector, db as database, tbl as "table", op, count(*) as n_rows from bl where db = 'financeiro' group by all"""),
    "redo_events": _redo("""
select 'ora-fin' as connector, 'ORCLPDB1' as database, 'FIN' as "schema", 'ORDERS' as "table",
  coalesce(tx_name, 'ora-tx-' || cast(k as varchar)) as tx, op, epoch_us(o_orderdate) as ts_us, k as ord,
  cast(k as varchar) as "offset", k as commit_ord, cast(k as varchar) as commit_offset
from redo where op <> 'DDL'"""),
    "redo_nested": """
select o_orderkey as k, cast(o_orderkey as varchar) as "key",
  repeat('F(', cast(o_orderkey % 8 + 1 as integer)) || '''it''''s (''' || repeat(')', cast(o_orderkey % 8 + 1 as integer)) as value
from orders""",
    "redo_insert": _redo("""
select k as ord, cast(k as varchar) as key, o_orderstatus as status, 'TO_DATE(''2024-01-01'', ''YYYY-MM-DD'')' as date,
  'it''s, (' || o_orderpriority || ')' as note, cast(4 as integer) as n
from redo where op = 'INSERT' and good"""),
    "redo_update": _redo("""
select k as ord, cast(k as varchar) as key, o_orderstatus as old_status, 'AAA' || cast(k as varchar) as row_id,
  cast(5 as integer) as n_before, true as has_note, case when o_orderstatus <> 'F' then 'F' end as new_status,
  cast(case when o_orderstatus <> 'F' then 1 else 0 end as integer) as n_after
from redo where op = 'UPDATE' and good"""),
    "redo_delete": _redo("""
select k as ord, cast(k as varchar) as key, o_orderstatus as status, cast(2 as integer) as n, true as no_after
from redo where op = 'DELETE' and good"""),
    "redo_literal_text": _redo("""
select k as ord, op as operation, case op when 'INSERT' then 'it''''s, (' || o_orderpriority || ')' end as note,
  cast(case op when 'UPDATE' then 4 when 'DELETE' then 2 end as integer) as n_before
from redo where op <> 'DDL' and good"""),
    "raw_sql": _redo("""
select k as ord, op, case op when 'DELETE' then sql_redo end as before_raw,
  case when op <> 'DELETE' then sql_redo end as after_raw
from redo where op <> 'DDL' and not good"""),
    "delta": _chlog("""
select connector, ord,
  cast((old_cents <> new_cents)::integer + (old_props <> new_props)::integer as integer) as n,
  case when old_cents <> new_cents then new_cents end as cents,
  case when old_props <> new_props then new_props end as props, false as pk_changed
from chlog where op = 'UPDATE'"""),
    "event_ids": _chlog(f"select connector, ord, op, {_id()} as event_id from everything"),
    # filters
    "owner_filter": _redo("""
select scn, op as operation, tx_name from redo where scn >= 100 and con = 'ORCLPDB1'"""),
    "dedup_fingerprint": _redo("select scn, k as ord, op as operation, sql_redo from redo"),
    "dlq": _redo("""
select 'cdc.dlq.ora-fin' as topic, 'ora-fin' as connector, 'statement not understood' as reason,
  'merge into x using y on ''?''' as payload, k as ord from redo where op <> 'DDL' and not good"""),
    "obfuscate": _redo("""
select scn, regexp_replace(sql_redo, '''(?:[^'']|'''')*''', '''?''', 'g') as masked from redo"""),
    "obfuscate_numbers": """
select o_orderkey, 'insert into T' || cast(o_orderkey % 10 as varchar) || '("C 1",SAL2,D) values (?, -?, DATE ''?'', ''?'') ?' ||
  chr(10) || '?;' as masked from orders""",
    # transactions
    "commit_gate": _chlog(f"""
select connector, tbl as "table", tx, op, ord, commit_ord, epoch_us(commit_ts) as commit_us,
  {_offset('commit_ord')} as commit_offset, new_props as props from committed"""),
    "commit_gate_stream": _chlog(_GATE),
    "emit_order": _chlog("""
select connector, tx, commit_ord, row_number() over (partition by connector, tx order by ord) as tx_seq, ord
from committed"""),
    "tx_cap": _chlog("""
select connector, ord, tx_seq, tx_seq <= 3 as kept from (
  select *, row_number() over (partition by connector, tx order by ord) as tx_seq from chlog)"""),
    "uncommitted": _chlog("select connector, tx, ord, op from attributed where commit_ord is null"),
    "tx_summary": _chlog("""
select connector, tx, max(commit_ord) as commit_ord, count(*) as n_rows,
  string_agg(distinct 'public.' || tbl, ',' order by 'public.' || tbl) as tables,
  min(ord) as first_ord, max(ord) as last_ord
from committed group by connector, tx"""),
    # routing and sinks
    "routed": _chlog("select 'cdc.' || connector || '.public.' || tbl as topic, ord, op from chlog"),
    "json_value": _chlog(f"""
select 'cdc.' || connector || '.public.' || tbl as topic, {_id()} as key, {_JSON} as value from chlog"""),
    "keyed_messages": _chlog("""
select 'cdc.' || connector || '.public.' || tbl as topic, cast(pk as varchar) as key, ord from chlog"""),
    "lake_sink": _chlog("""
select 'cdc.' || connector || '.public.' || tbl as topic, op, count(*) as events, max(ord) as last_ord
from committed group by all"""),
    "published_batches": _chlog(f"""
select connector, tbl as "table", pk, op, ord, new_cents as cents from {_STATE} where rn = 1 and op <> 'DELETE'"""),
    # offsets
    "offset_value": _chlog("""select connector, ord, case when ord % 7 = 0 then '' else off end as "offset" from chlog"""),
    "offset_key": _chlog("""
select connector, ord, case when connector_type = 'mysql' then ord // 100000 else 0 end as file,
  case when connector_type = 'mysql' then ord % 100000 else ord end as position from chlog"""),
    "offsets": _chlog(f"""
select connector, connector_type, {_offset('commit_ord')} as "offset", commit_ord from (
  select connector, connector_type, max(commit_ord) as commit_ord from committed group by all)"""),
    "resume": _chlog("""
, stored as (
  select connector, min(ord) as start from everything
  where op = 'COMMIT' and ord % 5 = 1 and connector <> 'ora-fin' group by all)
select e.connector, e.ord, e.op from everything e left join stored s using (connector)
where s.start is null or e.ord >= s.start"""),
    "scn_position": "select 'ora-fin' as connector, max(o_orderkey) as scn from orders",
    # metrics
    "events_processed": _chlog("""
select connector, 'public' as "schema", tbl as "table", op, count(*) as events from chlog group by all"""),
    "events_processed_stream": _chlog("""
select connector, 'public' as "schema", tbl as "table", op, count(*) as events from chlog group by all"""),
    "replication_lag": _chlog("""
, lags as (select connector, greatest(epoch_ms(ingested_at) - epoch_ms(ts), 0) as lag from everything)
select connector, count(*) as events, cast(sum(lag) as bigint) as total_ms, max(lag) as max_ms,
  quantile_disc(lag, 0.5) as p50_ms, quantile_disc(lag, 0.99) as p99_ms from lags group by all"""),
    "replication_lag_windows": _chlog("""
, lags as (
  select connector, date_trunc('day', ts) as day, greatest(epoch_ms(ingested_at) - epoch_ms(ts), 0) as lag from everything)
select connector, epoch_us(day) as day_us, count(*) as events, cast(sum(lag) as bigint) as total_ms, max(lag) as max_ms,
  quantile_disc(lag, 0.5) as p50_ms, quantile_disc(lag, 0.99) as p99_ms from lags group by all"""),
    "events_processed_windows": _chlog("""
select connector, 'public' as "schema", tbl as "table", op, epoch_us(date_trunc('hour', ts)) as hour_us, count(*) as events
from chlog group by all"""),
    "buffer_size": _chlog("""
select connector, count(*) filter (where commit_ord is null) as buffered from attributed group by all"""),
    "buffer_timeline": _chlog("""
, steps as (
  select connector, date_trunc('hour', ts) as bucket, 1 as step from attributed
  union all
  select connector, date_trunc('hour', commit_ts), -1 from committed),
per_bucket as (select connector, bucket, sum(step) as step from steps group by all)
select connector, epoch_us(bucket) as bucket_us,
  cast(sum(step) over (partition by connector order by bucket) as bigint) as buffered from per_bucket"""),
    "connector_status": """
select cast(c_custkey as varchar) as connector, 'oracle' as connector_type, epoch_us(last_seen) as last_seen_us,
  cast(coalesce((last_seen >= timestamp '2001-01-01' - interval 400 days)::integer, 0) as integer) as status
from customer left join (select o_custkey, max(o_orderdate) as last_seen from orders group by 1) o on o_custkey = c_custkey""",
    "current_position": _chlog(f"""
select connector, connector_type, {_offset('ord')} as "offset" from (
  select connector, connector_type, max(ord) as ord from everything group by all)"""),
    # lake
    "dedup_events": _chlog(f"select {_id()} as event_id, connector, ord from chlog"),
    "typed_rows": _chlog("""
select connector, ord, pk, cast(new_cents as integer) as cents, cast(null as integer) as props,
  cast(1 as integer) as cast_failures from chlog where op <> 'DELETE'"""),
    "current_state": _chlog(f"""
select tbl as "table", pk, op, connector, ord, commit_ord, new_cents as cents, new_props as props
from {_STATE} where rn = 1 and op <> 'DELETE'"""),
    "current_state_stream": _chlog(f"""
select tbl as "table", pk, op, connector, ord, commit_ord, new_cents as cents, new_props as props
from {_STATE} where rn = 1 and op <> 'DELETE'"""),
    "full_after": _redo("""
select k as ord, cast(5 as integer) as n, cast(k as varchar) as key, 'F' as status, o_orderpriority as priority
from redo where op = 'UPDATE' and good"""),
    "fill_toast": _chlog("""
, images as (
  select pk, ord, new_cents,
    case when ord % 8 <> 0 then new_props when op = 'UPDATE' and ord % 16 <> 0 then old_props end as known
  from chlog where op <> 'DELETE')
select pk, ord, coalesce(last_value(known ignore nulls) over (partition by pk order by ord), '__TOASTED_VALUE__') as props,
  new_cents as cents from images"""),
    "history": _chlog("""
select connector, tbl as "table", pk, commit_ord, ord, epoch_us(commit_ts) as from_us,
  epoch_us(lead(commit_ts) over (partition by connector, tbl, pk order by commit_ord, ord)) as to_us from committed"""),
    "changed_columns": _chlog("""
select connector, 'public' as "schema", tbl as "table", 'cents' as "column", count(*) as changes
from chlog where op = 'UPDATE' and old_cents <> new_cents group by all
union all
select connector, 'public', tbl, 'props', count(*) from chlog where op = 'UPDATE' and old_props <> new_props group by all"""),
    "windowed_activity": _chlog("""
select connector, 'public' as "schema", tbl as "table", epoch_us(date_trunc('hour', ts)) as start_us,
  epoch_us(date_trunc('hour', ts)) + 3600000000 as end_us, count(*) as events from chlog group by all"""),
    "event_round_trip": _chlog("""
select connector, connector_type, 'fin' as database, sch as "schema", tbl as "table", op, count(*) as n,
  count(*) as n_ids, epoch_us(max(ts)) as last_us from everything group by all"""),
    # whole paths
    "postgres_published": _pg("""
select 'cdc.' || connector || '.public.' || tbl as topic, op, count(*) as events, min(ord) as first_ord,
  max(commit_ord) as last_commit from pg where reason is null and commit_ord is not null group by all"""),
    "mysql_published": _binlog("""
select 'cdc.' || connector || '.financeiro.' || tbl as topic, op, count(*) as events, min(ord) as first_ord,
  max(commit_ord) as last_commit from bl where db = 'financeiro' and commit_ord is not null group by all"""),
    "oracle_published": _redo("""
select 'cdc.ora-fin.FIN.ORDERS' as topic, op, count(*) as events, min(k) as first_ord, max(k) as last_commit
from redo where op <> 'DDL' and good and con = 'ORCLPDB1' and k >= 100 group by all"""),
}

# A stream gives what the batch gives.
ORACLES["postgres_stream"] = ORACLES["postgres_published"]
ORACLES["mysql_stream"] = ORACLES["mysql_published"]
ORACLES["stream_accounting"] = _pg("""
select case when reason is not null then 'dead letter' when commit_ord is null then 'waiting' else 'published' end as outcome,
  connector, count(*) as n_rows, cast(sum(ord) as bigint) as sum_ord
from pg group by all""")
ORACLES["gate_accounting"] = _chlog("""
select case when commit_ord is null then 'waiting' else 'committed' end as outcome, connector, count(*) as n_rows,
  cast(sum(ord) as bigint) as sum_ord
from attributed group by all""")
ORACLES["resume_pruned"] = ORACLES["resume"]
ORACLES["oracle_stream"] = ORACLES["oracle_published"]
ORACLES["oracle_accounting"] = _redo("""
, mine as (select * from redo where con = 'ORCLPDB1' and k >= 100),
outcomes as (
  select case when good then 'published' else 'dead letter' end as outcome, k from mine where op <> 'DDL'
  union all
  select 'late', k from mine where floor(k * 5 / ((select max(k) from redo) + 1)) = 0)
select outcome, 'ora-fin' as connector, count(*) as n_rows, cast(sum(k) as bigint) as sum_ord from outcomes group by all""")
