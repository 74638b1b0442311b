"""Registered queries over the given tables, each with the SQL that gives the same rows.

Every query runs over whole tables. Landed records (JSON payloads, response pages, page
logs) are derived from the tables by Spark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import convert, shaping
from tidemark.functions.conform import conform
from tidemark.model import APPEND, CDC, SNAPSHOT, TableDef
from tidemark.operators import contract, cursor, filters, joins, paging, shape
from tidemark.operators.append import dedupe_append
from tidemark.operators.changes import END, START, apply_changes, refresh_history
from tidemark.operators.latest import latest_per_key
from tidemark.operators.snapshot import apply_snapshot, open_history, snapshot_diff
from tidemark.plans import service_tables
from tidemark.plans.ingest import ingest
from tidemark.plans.target import TargetTable
from tidemark.sources import metadata
from tidemark.sources.catalog import CATALOG
from tidemark.sources.catalog.fields import fields
from tidemark.sources.landed import LandedSource, scan_table, stream_table
from tidemark.sources.records import comment_records, table_rows
from tidemark.streaming.flows import append_flow, upsert_stream
from tidemark.workspace import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return scan_table(spark, f"{sf}/{name}.parquet")


def as_payload(df: DataFrame, *keep: str, name: str = "payload") -> DataFrame:
    """Rows as landed JSON records."""
    options = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return df.select(*keep, F.to_json(F.struct("*"), options).alias(name))


def iso(column: str) -> Column:
    return F.date_format(column, convert.ISO_SECONDS)


# -- change flows -----------------------------------------------------------------------

_LATEST_EVENTS = """
select * from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""


@query("cdc_scd1", _LATEST_EVENTS)
def cdc_scd1(spark, sf):
    return apply_changes(table(spark, sf, "events"), "user_id", ["ts", "event_id"])


@query("latest_per_key_ranked", _LATEST_EVENTS)
def latest_ranked(spark, sf):
    return latest_per_key(table(spark, sf, "events"), "user_id", ["ts", "event_id"], ranked=True)


@query("latest_per_key_aggregate", _LATEST_EVENTS)
def latest_aggregate(spark, sf):
    return latest_per_key(table(spark, sf, "events"), "user_id", ["ts", "event_id"], ranked=False)


def _land_parts(spark, sf, name: str, by: str, parts: int) -> str:
    """A table as several landed files, so that a stream has several micro-batches."""
    folder = shared_folder(spark, f"landed-{name}")
    table(spark, sf, name).repartitionByRange(parts, by).write.parquet(folder)
    return folder


@query("cdc_scd1_stream", _LATEST_EVENTS)
def cdc_scd1_stream(spark, sf):
    landed = _land_parts(spark, sf, "events", "event_id", 5)
    root = shared_folder(spark, "cdc-stream")
    target = TargetTable(spark, f"{root}/data", "user_id", ["ts", "event_id"], keep_versions=2)
    rows = stream_table(spark, landed, table(spark, sf, "events").schema, max_files=1)
    upsert_stream(rows, target, f"{root}/checkpoint").awaitTermination()
    return target.read()


@query("cdc_stale_replay", _LATEST_EVENTS)
def cdc_stale_replay(spark, sf):
    target = TargetTable(
        spark, shared_folder(spark, "cdc-replay"), "user_id", ["ts", "event_id"], keep_versions=2
    )
    first, second, third = _event_periods(spark, sf)
    for batch_id, batch in [(0, first), (1, third), (1, third), (2, second), (3, first)]:
        target.upsert(batch, batch_id)
    return target.read()


def _event_periods(spark, sf) -> list[DataFrame]:
    """The events before the 11th, up to the 21st, and from then on."""
    events = table(spark, sf, "events")
    first, second = (F.lit(day).cast("timestamp_ntz") for day in ("2024-01-11", "2024-01-21"))
    ts = F.col("ts")
    return [events.where(ts < first), events.where((ts >= first) & (ts < second)), events.where(ts >= second)]


@query(
    "target_changes",
    """
with before as (
  select * from events where ts < timestamp '2024-01-11'
  qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1),
after as (
  select * from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
select a.*, case when b.user_id is null then 'insert' else 'update' end as change_type
from after a left join before b on a.user_id = b.user_id where b.event_id is distinct from a.event_id""",
)
def target_changes(spark, sf):
    """What two batches changed, between two versions of a target, a later version notwithstanding."""
    target = TargetTable(spark, shared_folder(spark, "feed"), "user_id", ["ts", "event_id"])
    early, middle, late = _event_periods(spark, sf)
    for number, batch in enumerate((early, late, middle, early)):
        target.upsert(batch, number)
    return target.changes(0, 2)


@query(
    "target_schema_versions",
    """
select user_id, event_id, ts, case when ts >= timestamp '2024-01-21' then event_type end as event_type,
       case when ts >= timestamp '2024-01-11' then user_id * 2 else user_id end::bigint as n
from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
)
def target_schema_versions(spark, sf):
    """Batches of one target whose columns differ: one is widened from int to bigint, one is added, none is lost."""
    target = TargetTable(spark, shared_folder(spark, "schemas"), "user_id", ["ts", "event_id"])
    early, middle, late = (b.select("user_id", "event_id", "ts", "event_type") for b in _event_periods(spark, sf))
    target.upsert(early.drop("event_type").withColumn("n", F.col("user_id").cast("int")), 0)
    target.upsert(late.withColumn("n", F.col("user_id") * 2), 1)
    target.upsert(middle.drop("event_type").withColumn("n", F.col("user_id") * 2), 2)
    return target.read()


_EVENT_HISTORY = """
with flagged as (
  select user_id, event_type, ts, event_id,
         lag(event_type) over (partition by user_id order by ts, event_id) as before
  from events),
kept as (select * from flagged where before is distinct from event_type)
select user_id, event_type, ts as start_at,
       lead(ts) over (partition by user_id order by ts, event_id) as end_at
from kept"""


def _event_changes(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")


def _event_spans(history: DataFrame) -> DataFrame:
    return history.select(
        "user_id", "event_type", F.col(START).alias("start_at"), F.col(END).alias("end_at")
    )


@query("cdc_scd2", _EVENT_HISTORY)
def cdc_scd2(spark, sf):
    changes = _event_changes(spark, sf)
    return _event_spans(apply_changes(changes, "user_id", ["ts", "event_id"], scd_type=2))


@query("cdc_scd2_target", _EVENT_HISTORY)
def cdc_scd2_target(spark, sf):
    """The stored history after batches out of order: late changes cut the intervals of their keys."""
    target = TargetTable(spark, shared_folder(spark, "history"), "user_id", ["ts", "event_id"], scd_type=2)
    early, middle, late = (b.select("user_id", "ts", "event_id", "event_type") for b in _event_periods(spark, sf))
    for number, batch in enumerate((late, early, middle)):
        target.upsert(batch, number)
    return _event_spans(target.read())


@query("cdc_scd2_hot_keys", _EVENT_HISTORY)
def cdc_scd2_hot_keys(spark, sf):
    """Same history with every larger group cut into chunks."""
    changes = _event_changes(spark, sf)
    spans = apply_changes(changes, "user_id", ["ts", "event_id"], scd_type="SCD_TYPE_2", pieces=64)
    return _event_spans(spans)


@query("cdc_scd2_refresh", _EVENT_HISTORY)
def cdc_scd2_refresh(spark, sf):
    """History before a batch, then only the keys of the batch again."""
    log = _event_changes(spark, sf)
    late = F.col("ts") >= F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    before = apply_changes(log.where(~late), "user_id", ["ts", "event_id"], scd_type=2)
    return _event_spans(refresh_history(before, log, log.where(late), "user_id", ["ts", "event_id"]))


@query(
    "cdc_deletes",
    """
select * from (
  select * from events
  qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
where event_type <> 'error'""",
)
def cdc_deletes(spark, sf):
    events = table(spark, sf, "events")
    return apply_changes(events, "user_id", ["ts", "event_id"], apply_as_deletes="event_type = 'error'")


@query(
    "cdc_scd2_deletes",
    f"""
select * from ({_EVENT_HISTORY}) where event_type <> 'error'""",
)
def cdc_scd2_deletes(spark, sf):
    """A delete closes the open row and is no row itself."""
    spans = apply_changes(
        _event_changes(spark, sf), "user_id", ["ts", "event_id"], scd_type=2,
        apply_as_deletes="event_type = 'error'",
    )
    return _event_spans(spans)


@query(
    "cdc_close_update",
    """
select o_custkey, o_orderkey, o_orderstatus, o_orderstatus = 'F' as closed from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""",
)
def cdc_close_update(spark, sf):
    """A closed row is an update like any other: no delete predicate."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    latest = apply_changes(orders, "o_custkey", ["o_orderdate", "o_orderkey"])
    return latest.select("o_custkey", "o_orderkey", "o_orderstatus", (F.col("o_orderstatus") == "F").alias("closed"))


# -- snapshot flows ---------------------------------------------------------------------

_OPEN_ORDERS = """
select o_custkey, o_orderkey, o_orderstatus, o_totalprice from (
  select * from orders where o_orderdate < timestamp '{day}'
  qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)
where o_orderstatus <> 'F'"""
_SNAPSHOTS = f"with o as ({_OPEN_ORDERS.format(day='1996-01-01')}), n as ({_OPEN_ORDERS.format(day='2999-01-01')})"


def _open_orders(spark, sf, day: str) -> DataFrame:
    """The newest order of every customer on a day, unless it is finished."""
    orders = table(spark, sf, "orders").where(F.col("o_orderdate") < F.lit(day).cast("timestamp_ntz"))
    orders = orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    latest = latest_per_key(orders, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")
    return latest.where(F.col("o_orderstatus") != "F")


def _two_snapshots(spark, sf) -> tuple[DataFrame, DataFrame]:
    return _open_orders(spark, sf, "1996-01-01"), _open_orders(spark, sf, "2999-01-01")


@query(
    "snapshot_diff",
    _SNAPSHOTS
    + """
select coalesce(n.o_custkey, o.o_custkey) as o_custkey,
       case when n.o_custkey is null then o.o_orderkey else n.o_orderkey end as o_orderkey,
       case when n.o_custkey is null then o.o_orderstatus else n.o_orderstatus end as o_orderstatus,
       case when n.o_custkey is null then o.o_totalprice else n.o_totalprice end as o_totalprice,
       case when o.o_custkey is null then 'insert' when n.o_custkey is null then 'delete' else 'update' end
         as change_type
from o full join n on o.o_custkey = n.o_custkey
where o.o_orderkey is distinct from n.o_orderkey or o.o_orderstatus is distinct from n.o_orderstatus
   or o.o_totalprice is distinct from n.o_totalprice""",
)
def q_snapshot_diff(spark, sf):
    old, new = _two_snapshots(spark, sf)
    return snapshot_diff(old, new, "o_custkey")


@query("snapshot_apply", _OPEN_ORDERS.format(day="2999-01-01"))
def snapshot_apply(spark, sf):
    old, new = _two_snapshots(spark, sf)
    target = TargetTable(spark, shared_folder(spark, "snapshot"), "o_custkey")
    target.replace(old, 0)
    target.replace(new, 1)
    return target.read()


@query(
    "snapshot_incomplete",
    _SNAPSHOTS + "select * from n union all select * from o where o_custkey not in (select o_custkey from n)",
)
def snapshot_incomplete(spark, sf):
    """A snapshot that was cut short removes nothing."""
    old, new = _two_snapshots(spark, sf)
    return apply_snapshot(old, new, "o_custkey", complete=False)


@query(
    "snapshot_scd2",
    _SNAPSHOTS
    + """
select o.o_custkey, o.o_orderkey, o.o_orderstatus, o.o_totalprice, 1::bigint as start_at,
       case when n.o_custkey is null or o.o_orderkey <> n.o_orderkey
              or o.o_orderstatus is distinct from n.o_orderstatus
              or o.o_totalprice is distinct from n.o_totalprice then 2::bigint end as end_at
from o left join n on o.o_custkey = n.o_custkey
union all
select n.o_custkey, n.o_orderkey, n.o_orderstatus, n.o_totalprice, 2::bigint, null
from n left join o on o.o_custkey = n.o_custkey
where o.o_custkey is null or o.o_orderkey <> n.o_orderkey
   or o.o_orderstatus is distinct from n.o_orderstatus or o.o_totalprice is distinct from n.o_totalprice""",
)
def snapshot_scd2(spark, sf):
    old, new = _two_snapshots(spark, sf)
    first = open_history(old, F.lit(1).cast("bigint"))
    history = apply_snapshot(first, new, "o_custkey", scd_type=2, version=F.lit(2).cast("bigint"))
    return history.withColumnsRenamed({START: "start_at", END: "end_at"})


# -- append flows -----------------------------------------------------------------------


@query("append_dedupe", "select * from events")
def append_dedupe(spark, sf):
    """Stored rows and the rows to append, where everything is sent twice."""
    events = table(spark, sf, "events")
    stored = events.where(F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz"))
    return stored.unionByName(dedupe_append(events.unionByName(events), "event_id", stored=stored))


@query("append_stream", "select * from events")
def append_stream(spark, sf):
    """Two runs on one checkpoint: the second goes on where the first ended."""
    events = table(spark, sf, "events")
    landed, root = shared_folder(spark, "landed-append"), shared_folder(spark, "append")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (events.where(early), events.where(~early)):
        part.write.mode("append").parquet(landed)
        rows = stream_table(spark, landed, events.schema)
        append_flow(rows, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    return scan_table(spark, f"{root}/data")


@query("append_dedupe_stream", "select event_id, user_id, event_type, value from events")
def append_dedupe_stream(spark, sf):
    """A stream that sends every row twice, in different micro-batches."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    landed, root = shared_folder(spark, "landed-twice"), shared_folder(spark, "append-once")
    for _ in range(2):
        events.repartitionByRange(2, "event_id").write.mode("append").parquet(landed)
    rows = stream_table(spark, landed, events.schema, max_files=2)
    append_flow(rows, f"{root}/data", f"{root}/checkpoint", keys=["event_id"]).awaitTermination()
    return scan_table(spark, f"{root}/data").select(*events.columns)


# -- cursors and bounded reads ----------------------------------------------------------


@query("since_inclusive", "select * from events where ts >= timestamp '2024-01-20 00:00:00'")
def since_inclusive(spark, sf):
    return cursor.scan_since(table(spark, sf, "events"), "ts", "2024-01-20 00:00:00", "2024-01-01")


@query("since_start_date", "select * from orders where o_orderdate >= timestamp '1997-01-01'")
def since_start_date(spark, sf):
    """No stored mark yet: the configured start counts."""
    return cursor.scan_since(table(spark, sf, "orders"), "o_orderdate", None, "1997-01-01")


@query("since_unreadable", "select * from events")
def since_unreadable(spark, sf):
    """A mark that is no time reads from the start."""
    return cursor.scan_since(table(spark, sf, "events"), "ts", "soon", "2024-01-16")


@query(
    "read_between",
    "select * from events where ts > timestamp '2024-01-10' and ts <= timestamp '2024-01-20'",
)
def read_between(spark, sf):
    return cursor.read_between(table(spark, sf, "events"), "ts", "2024-01-10", "2024-01-20")


@query(
    "high_water_mark",
    """select event_type, greatest(max(ts), timestamp '2024-01-30 23:30:00') as high_water_mark
       from events group by event_type""",
)
def high_water_mark(spark, sf):
    previous = F.lit("2024-01-30 23:30:00").cast("timestamp_ntz")
    return cursor.high_water_mark(table(spark, sf, "events"), "ts", ["event_type"], previous)


@query(
    "next_cursor",
    """select user_id, strftime(max(ts) - interval 300 second, '%Y-%m-%dT%H:%M:%SZ') as next_cursor
       from events group by user_id""",
)
def next_cursor(spark, sf):
    events = table(spark, sf, "events").select("user_id", iso("ts").alias("updated_at"))
    return cursor.next_cursor(events, "updated_at", ["user_id"])


@query("bounded_batch", "select * from events order by ts, event_id limit 5000")
def bounded_batch(spark, sf):
    return paging.bounded_batch(table(spark, sf, "events"), ["ts", "event_id"], paging.batch_rows("250", "x"))


@query(
    "bounded_batch_after",
    """select * from orders
       where o_orderdate > timestamp '1997-01-01' or (o_orderdate = timestamp '1997-01-01' and o_orderkey > 5000)
       order by o_orderdate, o_orderkey limit 300""",
)
def bounded_batch_after(spark, sf):
    """A capped batch that goes on inside a group of equal cursor values."""
    orders, order = table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"]
    after = {"o_orderdate": "1997-01-01", "o_orderkey": 5000}
    return paging.bounded_batch(orders, order, paging.batch_rows(per_page=100, max_pages=3), after=after)


@query("keyset_page", "select * from customer where c_custkey > 700 order by c_custkey limit 100")
def keyset_page(spark, sf):
    return paging.keyset_page(table(spark, sf, "customer"), "c_custkey", 700)


_ORDER_PAGES = """
select o_orderkey, o_custkey,
       ((row_number() over (order by o_orderkey) - 1) // 100 + 1)::bigint as page
from orders"""


@query("assign_pages", _ORDER_PAGES)
def assign_pages(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return paging.assign_pages(orders, "o_orderkey")


@query("assign_pages_hot", _ORDER_PAGES)
def assign_pages_hot(spark, sf):
    """The same with the whole table cut into ordered chunks."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return paging.assign_pages(orders, "o_orderkey", pieces=64)


# -- conform ----------------------------------------------------------------------------

_EVENT_SCHEMA = (
    T.StructType()
    .add("event_id", T.LongType(), False)
    .add("ts", T.TimestampType())
    .add("user_id", T.LongType())
    .add("event_type", T.StringType())
    .add("value", T.DoubleType())
    .add("props", T.StringType())
)
_EVENT_ROWS = "select event_id, epoch_us(ts) as ts_us, user_id, event_type, value, props from events"


def _micros(df: DataFrame) -> DataFrame:
    return df.withColumn("ts_us", F.unix_micros("ts")).drop("ts")


@query("conform_events", _EVENT_ROWS)
def conform_events(spark, sf):
    return _micros(conform(as_payload(table(spark, sf, "events")), "payload", _EVENT_SCHEMA))


def _turn(*choices: Column) -> Column:
    """A spelling for each row, in turn by its key."""
    at = F.pmod(F.col("event_id"), F.lit(len(choices)))
    out = choices[0]
    for i, c in enumerate(choices[1:], 1):
        out = F.when(at == i, c).otherwise(out)
    return out


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


@query(
    "conform_lenient",
    """
select event_id, cast(trunc(value) as bigint) as whole, value as number,
       cast(cast(value as decimal(12,2)) as varchar) as exact,
       event_id % 10 < 5 as flag, strftime(ts, '%Y-%m-%d') as day, epoch_us(date_trunc('second', ts)) as at_us
from events""",
)
def conform_lenient(spark, sf):
    value = F.col("value").cast("string")
    words = [*convert.TRUE_WORDS, *convert.FALSE_WORDS]
    days = [F.date_format("ts", p) for p in ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MM-yyyy", "yyyy/MM/dd")]
    plain = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    east = F.concat(F.date_format(F.expr("ts + interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    seconds = F.unix_seconds(convert.to_timestamp_lenient(plain)).cast("string")
    whole = _turn(value, _quoted(value), _quoted(F.regexp_extract(value, r"^(\d+)", 1)))
    parts = {
        "event_id": F.col("event_id").cast("string"),
        "whole": whole,
        "number": _turn(value, _quoted(value)),
        "exact": _turn(_quoted(value), value),
        "flag": _turn(*[_quoted(F.upper(F.lit(w)) if i % 2 else F.lit(w)) for i, w in enumerate(words)]),
        "day": _turn(*[_quoted(d) for d in days], _quoted(iso("ts"))),
        "at": _turn(
            _quoted(iso("ts")), _quoted(plain), _quoted(F.date_format("ts", "yyyy/MM/dd HH:mm:ss")),
            _quoted(east), seconds,
        ),
    }
    body = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in parts.items()]), F.lit("}"))
    schema = (
        T.StructType()
        .add("event_id", T.LongType(), False)
        .add("whole", T.LongType())
        .add("number", T.DoubleType())
        .add("exact", T.DecimalType(12, 2))
        .add("flag", T.BooleanType())
        .add("day", T.DateType())
        .add("at", T.TimestampType())
    )
    rows = conform(table(spark, sf, "events").select(body.alias("payload")), "payload", schema)
    return rows.select(
        "event_id", "whole", "number", F.col("exact").cast("string").alias("exact"), "flag", F.col("day").cast("string").alias("day"),
        F.unix_micros("at").alias("at_us"),
    )


@query(
    "conform_nested",
    """
select c_custkey, c_name as owner_name, c_acctbal as owner_balance, c_nationkey::bigint as first_id, 3::bigint as n_ids,
       c_mktsegment as tag_segment, c_custkey as only_id, null::varchar as gone
from customer""",
)
def conform_nested(spark, sf):
    customer = table(spark, sf, "customer").select(
        "c_custkey",
        F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").cast("string").alias("balance")).alias("owner"),
        F.array(F.col("c_nationkey").cast("string"), F.lit("7"), F.col("c_custkey").cast("string")).alias("ids"),
        F.create_map(F.lit("segment"), F.col("c_mktsegment")).alias("tags"),
        F.col("c_custkey").alias("single"),
        F.lit(1).alias("not_in_schema"),
    )
    schema = (
        T.StructType()
        .add("c_custkey", T.LongType(), False)
        .add("owner", T.StructType().add("name", T.StringType(), False).add("balance", T.DoubleType()))
        .add("ids", T.ArrayType(T.LongType()))
        .add("tags", T.MapType(T.StringType(), T.StringType()))
        .add("single", T.ArrayType(T.LongType()))
        .add("gone", T.StringType())
    )
    rows = conform(as_payload(customer), "payload", schema)
    return rows.select(
        "c_custkey", *shaping.flatten("owner", ["name", "balance"]), F.col("ids")[0].alias("first_id"),
        F.size("ids").cast("bigint").alias("n_ids"), F.col("tags")["segment"].alias("tag_segment"),
        F.col("single")[0].alias("only_id"), "gone",
    )


@query(
    "conform_permissive",
    """
select o_orderkey, case when o_orderstatus = 'P' then cast(trunc(o_totalprice) as bigint) end as amount,
       (case when o_orderstatus = 'P' then 0 else 1 end + case when o_orderstatus = 'O' then 1 else 0 end)::bigint as n_errors
from orders""",
)
def conform_permissive(spark, sf):
    """Bad values become NULL and are listed; nothing is dropped."""
    status = F.col("o_orderstatus")
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status == "P", F.col("o_totalprice").cast("string")).otherwise(status).alias("amount"),
        F.when(status != "O", F.lit("2024-02-03")).otherwise(F.lit("2024-02-31")).alias("day"),
    )
    schema = T.StructType().add("o_orderkey", T.LongType(), False).add("amount", T.LongType()).add("day", T.DateType())
    rows = conform(as_payload(orders), "payload", schema, mode="permissive")
    return rows.select("o_orderkey", "amount", F.size("_errors").cast("bigint").alias("n_errors"))


# -- shaping ----------------------------------------------------------------------------


@query("json_field", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_field(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", convert.to_long(F.get_json_object("props", "$.k")).alias("k"))


@query("json_text", "select event_id, case when value >= 10 then props end as props_text from events")
def json_text(spark, sf):
    nested = F.when(F.col("value") >= 10, F.col("props")).otherwise(F.lit("{}"))
    return table(spark, sf, "events").select("event_id", shaping.json_text(nested).alias("props_text"))


@query(
    "json_text_struct",
    """select c_custkey, '{"segment":"' || c_mktsegment || '","note":null}' as detail from customer""",
)
def json_text_struct(spark, sf):
    detail = F.struct(F.col("c_mktsegment").alias("segment"), F.lit(None).cast("string").alias("note"))
    customer = table(spark, sf, "customer").select("c_custkey", detail.alias("detail"))
    return customer.select("c_custkey", shaping.json_text("detail", customer.schema["detail"].dataType).alias("detail"))


@query(
    "flatten",
    """select c_custkey, n_name as nation_name, n_regionkey as nation_regionkey, r_name as nation_region_name,
              'acme' as organization_login
       from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
)
def flatten(spark, sf):
    region = F.struct(F.col("r_name").alias("name")).alias("region")
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    nation = nation.select(
        "n_nationkey",
        F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("regionkey"), region).alias("nation"),
    )
    customer = table(spark, sf, "customer")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    flat = joined.select("c_custkey", *shaping.flatten("nation", ["name", "regionkey", "region.name"]))
    return shape.with_scope(flat, {"organization_login": "acme"})


@query(
    "flatten_map",
    """select o_orderkey, o_orderstatus as properties_status, o_custkey as properties_customer,
              null::varchar as properties_absent from orders""",
)
def flatten_map(spark, sf):
    entries = F.create_map(
        F.lit("status"), F.col("o_orderstatus"), F.lit("customer"), F.col("o_custkey").cast("string")
    )
    orders = table(spark, sf, "orders").select("o_orderkey", entries.alias("m"))
    wanted = {"status": "string", "customer": "bigint", "absent": "string"}
    return orders.select("o_orderkey", *shaping.flatten_map("m", wanted))


@query(
    "schema_from_catalog",
    """select event_id::varchar as id, event_type,
              case when event_type = 'click' then cast(trunc(value) as bigint) end as properties_click,
              case when event_type = 'error' then value::varchar end as properties_error
       from events""",
)
def schema_from_catalog(spark, sf):
    """Columns from a property catalogue: one property per event type, the clicks are numbers."""
    events = table(spark, sf, "events")
    kind = F.when(F.col("event_type") == "click", "number").otherwise("string")
    catalogue = events.select(F.col("event_type").alias("name"), kind.alias("type")).distinct()
    objects = metadata.schema_from_catalog(catalogue, "activity")
    records = events.select(
        F.col("event_id").cast("string").alias("id"),
        F.create_map("event_type", F.col("value").cast("string")).alias("properties"),
        "event_type",
    )
    rows = table_rows(as_payload(records, "event_type"), objects, keep=["event_type"])
    return rows.select("id", "event_type", "properties_click", "properties_error")


def _order_ids(spark, sf) -> DataFrame:
    """Customers with their orders as an association in JSON text."""
    orders = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").cast("string").alias("id"), "o_orderkey")
    nested = shape.nest_children(orders, ["o_custkey"], ["o_orderkey"], ["id"], name="results")
    customer = table(spark, sf, "customer").select("c_custkey")
    joined = customer.join(nested, F.col("c_custkey") == F.col("o_custkey"), "left")
    association = F.when(F.col("results").isNotNull(), F.to_json(F.struct("results")))
    ids = shaping.id_array(F.try_parse_json(association))
    return joined.select("c_custkey", F.coalesce("part", F.lit(0)).alias("part"), ids.alias("order_ids"))


@query(
    "id_array",
    """select c_custkey, 0::bigint as part, coalesce(string_agg(o_orderkey::varchar, ',' order by o_orderkey), '') as ids,
              count(o_orderkey)::bigint as n_ids
       from customer left join orders on c_custkey = o_custkey group by c_custkey""",
)
def id_array(spark, sf):
    return _order_ids(spark, sf).select(
        "c_custkey", "part", F.array_join("order_ids", ",").alias("ids"), F.size("order_ids").cast("bigint").alias("n_ids")
    )


@query(
    "association_edges",
    "select c_custkey as customer_id, o_orderkey::varchar as order_id from customer join orders on c_custkey = o_custkey",
)
def association_edges(spark, sf):
    return joins.association_edges(_order_ids(spark, sf), "c_custkey", "order_ids", names=("customer_id", "order_id"))


@query(
    "merge_records",
    """select o_orderkey, case when o_orderstatus = 'F' then 'done' else c_mktsegment end as label,
              c_name as name, o_orderpriority as priority
       from orders join customer on o_custkey = c_custkey""",
)
def merge_records(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    parent = F.create_map(F.lit("label"), F.col("c_mktsegment"), F.lit("name"), F.col("c_name"))
    base = F.create_map(F.lit("priority"), F.col("o_orderpriority"))
    done = F.create_map(F.lit("label"), F.lit("done"), F.lit("priority"), F.col("o_orderpriority"))
    child = F.when(F.col("o_orderstatus") == "F", done).otherwise(base)
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    merged = joined.select("o_orderkey", shaping.merge_records(parent, child).alias("m"))
    return merged.select("o_orderkey", *[F.col("m")[k].alias(k) for k in ("label", "name", "priority")])


@query(
    "falsy_to_null",
    """select l_orderkey, l_linenumber, l_partkey, l_shipdate,
              case when l_discount <> 0 then cast(l_discount as varchar) end as discount_text from lineitem""",
)
def falsy_to_null(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", shaping.falsy_to_null("l_discount").alias("discount_text")
    )


@query(
    "soft_delete_default",
    """select d.doc_id, coalesce(toxic = 1, false) as deleted
       from documents d left join labels l on d.doc_id = l.doc_id""",
)
def soft_delete_default(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", (F.col("toxic") == 1).alias("flag"))
    joined = table(spark, sf, "documents").select("doc_id").join(labels, "doc_id", "left")
    return joined.select("doc_id", shaping.with_default("flag", False).alias("deleted"))


@query(
    "union_tables",
    """select c_custkey as id, c_name as name, c_acctbal as balance, c_mktsegment as segment from customer
       union all select s_suppkey, s_name, s_acctbal, null from supplier""",
)
def union_tables(spark, sf):
    customer = table(spark, sf, "customer").withColumnsRenamed(
        {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"}
    )
    supplier = table(spark, sf, "supplier").withColumnsRenamed({"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"})
    return shape.union_tables(customer.drop("c_nationkey"), supplier.drop("s_nationkey"))


@query(
    "iso_times",
    """select event_id, epoch(date_trunc('second', ts))::bigint as s, epoch_ms(date_trunc('second', ts)) as ms,
              strftime(ts - interval 90 second, '%Y-%m-%dT%H:%M:%SZ') as earlier
       from events""",
)
def iso_times(spark, sf):
    events = table(spark, sf, "events").select("event_id", iso("ts").alias("at"))
    return events.select(
        "event_id", convert.epoch_seconds("at").alias("s"), convert.epoch_millis("at", 0).alias("ms"),
        convert.iso_minus_seconds("at", 90).alias("earlier"),
    )


# -- parents and children ---------------------------------------------------------------


@query(
    "expand_children",
    """select l.*, o_custkey as parent_custkey, o_orderstatus as parent_status
       from lineitem l join orders on l_orderkey = o_orderkey where o_orderstatus = 'O'""",
)
def expand_children(spark, sf):
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    carry = {"parent_custkey": "o_custkey", "parent_status": "o_orderstatus"}
    only = F.col("o_orderstatus") == "O"
    return joins.expand_children(orders, lines, {"o_orderkey": "l_orderkey"}, carry=carry, only=only)


def _turn_texts(children: str) -> Column:
    texts = F.transform(children, lambda x: F.concat(x["role"], F.lit(":"), F.length(x["text"]).cast("string")))
    return F.array_join(texts, "|")


@query(
    "nest_children",
    """select conv_id, 0::bigint as part, string_agg(role || ':' || length(text), '|' order by turn) as turns
       from conversations group by conv_id""",
)
def nest_children(spark, sf):
    turns = table(spark, sf, "conversations")
    nested = shape.nest_children(turns, ["conv_id"], ["turn"], ["role", "text"])
    return nested.select("conv_id", "part", _turn_texts("children").alias("turns"))


@query(
    "nest_children_parts",
    """
with numbered as (
  select *, (row_number() over (partition by conv_id order by turn) - 1) // 3 as part from conversations)
select conv_id, part::bigint as part, string_agg(role || ':' || length(text), '|' order by turn) as turns
from numbered group by conv_id, part""",
)
def nest_children_parts(spark, sf):
    """Large parents come in parts of three, and are numbered in ordered chunks."""
    turns = table(spark, sf, "conversations")
    nested = shape.nest_children(turns, ["conv_id"], ["turn"], ["role", "text"], max_children=3, pieces=64)
    return nested.select("conv_id", "part", _turn_texts("children").alias("turns"))


@query(
    "explode_children",
    "select conv_id, role, text from conversations where role = 'user'",
)
def explode_children(spark, sf):
    nested = shape.nest_children(table(spark, sf, "conversations"), ["conv_id"], ["turn"], ["role", "text"])
    rows = shape.explode_children(nested, "children", {"conv_id": "conv_id"}, where=lambda c: c["role"] == "user")
    return rows.select("conv_id", "child.role", "child.text")


@query(
    "expand_detail",
    """select c_custkey, c_nationkey, n_name as nation, n_regionkey as region
       from customer join nation on c_nationkey = n_nationkey""",
)
def expand_detail(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    carry = {"nation": "n_name", "region": "n_regionkey"}
    return joins.expand_detail(customer, table(spark, sf, "nation"), {"c_nationkey": "n_nationkey"}, carry=carry)


@query(
    "split_rejects",
    """select page_id, url, regexp_extract(url, '[?&]page=([0-9]+)', 1) = '' as rejected from pages""",
)
def split_rejects(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", shaping.page_number("url").alias("n"))
    good, bad = filters.split_rejects(pages, "n >= 0")
    tagged = [d.select("page_id", "url", F.lit(r).alias("rejected")) for d, r in ((good, False), (bad, True))]
    return shape.union_tables(*tagged)


# -- pages ------------------------------------------------------------------------------


def _bodies(spark, sf) -> DataFrame:
    """Events as response bodies of a hundred records; a body is bounded by the page size."""
    events = as_payload(table(spark, sf, "events"), "event_id", name="record")
    paged = paging.assign_pages(events, "event_id")
    bodies = paged.groupBy("page").agg(F.collect_list("record").alias("records"))
    body = F.concat(F.lit('{"events":['), F.array_join("records", ","), F.lit('],"count":100}'))
    return bodies.select("page", body.alias("body"))


@query("unnest_envelope", _EVENT_ROWS)
def unnest_envelope(spark, sf):
    records = paging.unnest_envelope(_bodies(spark, sf), "body", "events")
    return _micros(conform(records, "payload", _EVENT_SCHEMA))


_USER_PAGES = """
with numbered as (
  select *, (row_number() over (partition by user_id order by ts, event_id) - 1) // 10 + 1 as page from events),
pages as (
  select user_id, page::bigint as page, count(*)::bigint as n_rows, bool_or(event_type = 'error') as ended
  from numbered group by user_id, page),
last as (select user_id, max(page) as last_page from pages group by user_id)
"""


def _page_log(spark, sf) -> DataFrame:
    """One row per fetched page of a user's events, as a fetch log would have it."""
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    paged = paging.assign_pages(events, ["ts", "event_id"], 10, by=["user_id"])
    pages = paged.groupBy("user_id", "page").agg(
        F.count(F.lit(1)).alias("n_rows"), F.bool_or(F.col("event_type") == "error").alias("ended")
    )
    last = pages.groupBy("user_id").agg(F.max("page").alias("last_page"))
    return pages.join(last, "user_id")


def _url(page: Column) -> Column:
    return F.concat(F.lit("https://api.example.com/items?per_page=10&page="), page.cast("string"))


@query(
    "page_chain",
    _USER_PAGES
    + """
, ends as (
  select p.user_id, min(p.page) as first_end from pages p join last l on p.user_id = l.user_id
  where ended or page = last_page group by p.user_id)
select p.user_id, p.page, p.n_rows from pages p join ends e on p.user_id = e.user_id where p.page <= e.first_end""",
)
def page_chain(spark, sf):
    log = _page_log(spark, sf)
    more = F.when(F.col("page") < F.col("last_page"), _url(F.col("page") + 1)).otherwise(F.lit(""))
    log = log.withColumn("next_page", more)
    kept = paging.page_chain(log, ["user_id"], "page", next_page="next_page", end_of_stream="ended")
    return kept.select("user_id", "page", "n_rows")


@query(
    "next_link",
    _USER_PAGES
    + """
select p.user_id, p.page, case when page < last_page then page + 1 end as next_number
from pages p join last l on p.user_id = l.user_id""",
)
def next_link(spark, sf):
    last = F.concat(F.lit("<"), _url(F.col("last_page")), F.lit('>; rel="last"'))
    following = F.concat(F.lit("<"), _url(F.col("page") + 1), F.lit('>; rel="next"'))
    link = F.when(F.col("page") < F.col("last_page"), F.concat_ws(", ", following, last)).otherwise(last)
    log = _page_log(spark, sf).select("user_id", "page", link.alias("link"))
    return log.select("user_id", "page", shaping.page_number(shaping.next_link("link")).alias("next_number"))


@query(
    "next_token",
    _USER_PAGES
    + """
select p.user_id, p.page, case when page < last_page then 'p' || (page + 1) end as after
from pages p join last l on p.user_id = l.user_id""",
)
def next_token(spark, sf):
    token = F.format_string('{"results":[],"paging":{"next":{"after":"p%d"}}}', F.col("page") + 1)
    body = F.when(F.col("page") < F.col("last_page"), token).otherwise(F.lit('{"results":[]}'))
    log = _page_log(spark, sf).select("user_id", "page", body.alias("body"))
    return log.select("user_id", "page", shaping.next_token("body").alias("after"))


@query(
    "page_range",
    _USER_PAGES + "select user_id, page, n_rows from pages where page >= 3",
)
def page_range(spark, sf):
    return paging.page_range(_page_log(spark, sf), "page", 3).select("user_id", "page", "n_rows")


@query(
    "page_of_url",
    """select page_id, cast(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') as bigint) as number from pages""",
)
def page_of_url(spark, sf):
    return table(spark, sf, "pages").select("page_id", shaping.page_number("url").alias("number"))


# -- filters ----------------------------------------------------------------------------


@query("state_filter", "select * from orders where o_orderstatus = 'O'")
def state_filter(spark, sf):
    return filters.state_filter(table(spark, sf, "orders"), "o_orderstatus", "O")


@query("state_filter_all", "select * from orders")
def state_filter_all(spark, sf):
    return filters.state_filter(table(spark, sf, "orders"), "o_orderstatus")


@query(
    "exclude_archived",
    """select d.doc_id, lang from documents d left join labels l on d.doc_id = l.doc_id
       where coalesce(quality = 0, false) = false""",
)
def exclude_archived(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", (F.col("quality") == 0).alias("archived"))
    documents = table(spark, sf, "documents").select("doc_id", "lang").join(labels, "doc_id", "left")
    return filters.exclude_archived(documents).drop("archived")


@query("scan_scope", "select * from part where p_brand = 'Brand#2' and p_type = 'ECONOMY'")
def scan_scope(spark, sf):
    scope = {"p_brand": "Brand#2", "p_type": "ECONOMY"}
    return filters.scan_scope(table(spark, sf, "part"), scope, required=("p_brand", "p_type"))


# -- checks -----------------------------------------------------------------------------


@query(
    "rows_present",
    """select count(*)::bigint as missing_rows, count(*) = 0 as passed from customer where c_acctbal < 0""",
)
def rows_present(spark, sf):
    """Written rows come back under other names; those with a debt are lost on the way."""
    written = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    mapping = {c: f"properties_{c}" for c in ("c_custkey", "c_name", "c_acctbal")}
    returned = shape.rename_map(written.where(F.col("c_acctbal") >= 0), mapping)
    return joins.rows_present(written, returned, mapping)


@query("missing_rows", "select c_custkey, c_name from customer where c_acctbal < 0")
def missing_rows(spark, sf):
    written = table(spark, sf, "customer").select("c_custkey", "c_name")
    returned = table(spark, sf, "customer").where(F.col("c_acctbal") >= 0)
    return joins.missing_rows(written, returned, {"c_custkey": "c_custkey", "c_name": "c_name"})


@query("not_in", "select c_nationkey as key from customer except select s_nationkey from supplier")
def not_in(spark, sf):
    left = table(spark, sf, "customer").select(F.col("c_nationkey").alias("key"))
    right = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("key"))
    return joins.not_in(left, right, ["key"])


@query(
    "key_uniqueness",
    """select l_orderkey, l_linenumber, count(*)::bigint as n_rows from lineitem
       group by l_orderkey, l_linenumber having count(*) > 1""",
)
def key_uniqueness(spark, sf):
    return contract.key_uniqueness(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# table: keys, cursor, mode. The last two break a rule each.
_CONTRACTS = {
    "customer": (("c_custkey",), None, SNAPSHOT),
    "orders": (("o_orderkey",), "o_orderdate", CDC),
    "events": (("event_id",), "ts", CDC),
    "conversations": (("conv_id", "turn"), None, APPEND),
    "documents": (("doc_id",), None, APPEND),
    "benchmark": (("item_id",), None, APPEND),
    "pages": (("page_id",), None, SNAPSHOT),
    "lineitem": (("l_orderkey", "l_linenumber"), "l_shipdate", CDC),
    "supplier": (("s_suppkey",), "s_updated", CDC),
}
_NARROW = {"customer": 1, "lineitem": 1, "supplier": 1}
_WIDTH = {
    "customer": 5, "orders": 6, "events": 6, "conversations": 4, "documents": 5, "benchmark": 2,
    "pages": 3, "lineitem": 11, "supplier": 4,
}


def _contract_sql() -> str:
    parts = []

    def row(name, check, ok, value) -> None:
        parts.append(
            f"select '{name}' as \"table\", '{check}' as \"check\", "
            f"case when {ok} then 'passed' else 'failed' end as status, ({value})::bigint as value"
        )

    for name, (keys, mark, mode) in _CONTRACTS.items():
        key_list, no_key = ", ".join(keys), " or ".join(f"{k} is null" for k in keys)
        known = mark != "s_updated"
        row(name, "name_given", "true", len(name))
        row(name, "schema_given", "true", _WIDTH[name])
        row(name, "no_narrow_integer", f"{_NARROW.get(name, 0)} = 0", _NARROW.get(name, 0))
        row(name, "mode_known", "true", "null")
        row(name, "key_given", "true", len(keys))
        row(name, "key_in_schema", "true", 0)
        row(name, "cursor_given", "true", "null")
        row(name, "cursor_in_schema", str(known).lower(), "null")
        counts = {
            "has_rows": (f"(select count(*) > 0 from {name})", f"select count(*) from {name}"),
            "rows_conform": ("true", "0"),
            "key_not_null": (f"not exists (select 1 from {name} where {no_key})", f"select count(*) from {name} where {no_key}"),
        }
        repeated = f"select count(*) from (select 1 from {name} group by {key_list} having count(*) > 1)"
        counts["key_unique"] = (f"({repeated}) = 0", repeated)
        if mark and known:
            lost = f"select count(*) from {name} where {mark} is null"
            counts["cursor_not_null"] = (f"({lost}) = 0", lost)
        for check, (ok, value) in counts.items():
            row(name, check, ok, value)
    return "\nunion all\n".join(parts)


def _contracts(spark, sf) -> list[tuple[TableDef, DataFrame]]:
    out = []
    for name, (keys, mark, mode) in _CONTRACTS.items():
        df = table(spark, sf, name)
        out.append((TableDef(name, df.schema, keys, mark, mode), df))
    return out


def _report(spark, sf) -> DataFrame:
    pairs = _contracts(spark, sf)
    # A cursor that is not in the schema cannot be looked at in the data.
    checked = [(t if not t.cursor or t.cursor in df.columns else TableDef(t.name, t.schema, t.keys, None, APPEND), df) for t, df in pairs]
    parts = [contract.definition_checks(spark, [t for t, _ in pairs])]
    return shape.union_tables(*parts, *[contract.table_checks(df, t) for t, df in checked])


@query("contract_report", _contract_sql())
def contract_report(spark, sf):
    return _report(spark, sf)


@query(
    "contract_summary",
    f"""
with report as ({_contract_sql()})
select "table", count(*)::bigint as total, count(*) filter (status = 'passed')::bigint as passed,
       count(*) filter (status = 'failed')::bigint as failed, 0::bigint as errors,
       100.0::double * count(*) filter (status = 'passed') / count(*) as success_rate,
       case when count(*) filter (status = 'failed') > 0 then 'failed' else 'passed' end as status
from report group by "table" """,
)
def contract_summary(spark, sf):
    return contract.report_summary(_report(spark, sf), ["table"])


@query(
    "increment_check",
    """
select 'orders' as "table", 'increment' as "check",
       case when (select count(*) from orders where o_orderdate >= timestamp '1998-01-01') >= 1 then 'passed' else 'failed' end as status,
       (select count(*) from orders where o_orderdate >= timestamp '1998-01-01')::bigint as value
union all
select 'customer', 'increment',
       case when (select count(*) from customer where c_acctbal < 0) = 1 then 'passed' else 'failed' end,
       (select count(*) from customer where c_acctbal < 0)::bigint""",
)
def increment_check(spark, sf):
    """cdc: some row since the mark. snapshot: exactly the one written row more than before."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    changed = cursor.scan_since(orders, "o_orderdate", "1998-01-01")
    cdc = TableDef("orders", orders.schema, ("o_orderkey",), "o_orderdate", CDC)
    snapshot = TableDef("customer", customer.schema, ("c_custkey",), None, SNAPSHOT)
    before = customer.where(F.col("c_acctbal") >= 0)
    return contract.increment_check(cdc, orders, changed).unionByName(
        contract.increment_check(snapshot, before, customer)
    )


# -- listing and metadata ---------------------------------------------------------------


@query(
    "table_metadata",
    """
with asked as (
  select user_id, unnest(string_split(event_type || ', ,purchase , ' || lower(event_type), ',')) as name from events),
names as (select trim(name) as name from asked where trim(name) <> '')
select name as "tableName", 'event_id' as primary_key, case when name = 'error' then null else 'ts' end as cursor_field,
       case when name = 'error' then 'append' else 'cdc' end as ingestion_type, count(*)::bigint as n
from names group by name""",
)
def table_metadata(spark, sf):
    """Comma lists of table names, one per event, against a definition per event type."""
    events = table(spark, sf, "events")
    names = F.concat_ws(", ,", F.col("event_type"), F.concat(F.lit("purchase , "), F.lower("event_type")))
    definitions = events.select(
        F.col("event_type").alias("tableName"),
        F.array(F.lit("event_id")).alias("primary_key"),
        F.when(F.col("event_type") != "error", "ts").alias("cursor_field"),
        F.when(F.col("event_type") == "error", APPEND).alias("ingestion_type"),
    ).distinct()
    rows = metadata.table_metadata(events.select(names.alias("names")), "names", definitions)
    return rows.groupBy(
        "tableName", F.array_join("primary_key", ",").alias("primary_key"), "cursor_field", "ingestion_type"
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "discover_tables",
    """
select unnest(['contacts','companies','deals','tickets','calls','emails','meetings','tasks','notes']) as table_name
union all
select lower(p_name) from part where p_size not in (1, 2, 3, 5) and p_brand <> 'Brand#3'""",
)
def discover_tables(spark, sf):
    name = F.when(F.col("p_brand") == "Brand#3", F.lit("")).otherwise(F.upper("p_name"))
    kind = F.concat(F.lit("0-"), F.col("p_size").cast("string"))
    return metadata.discover_tables(table(spark, sf, "part").select(kind.alias("objectTypeId"), name.alias("name")))


@query(
    "write_and_read_back",
    """select count(*)::bigint as n_rows, count(*)::bigint as n_emails, 0::bigint as n_lost from customer""",
)
def write_and_read_back(spark, sf):
    """Customers written as contacts under the names they come back with, and compared with what comes back."""
    contacts = table(spark, sf, "customer").select(
        F.concat(F.lower(F.regexp_replace("c_name", "[^A-Za-z0-9]", ".")), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("lastname"), F.col("c_mktsegment").alias("company"),
    )
    mapping = {c: f"properties_{c}" for c in contacts.columns}
    path = shared_folder(spark, "contacts")
    shape.rename_map(contacts, mapping).write.parquet(path)
    returned = scan_table(spark, path)
    lost = joins.rows_present(contacts, returned, mapping).select(F.col("missing_rows").alias("n_lost"))
    sums = returned.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("properties_email").alias("n_emails"), F.lit(0).alias("n_lost")
    )
    both = sums.unionByName(lost, allowMissingColumns=True)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_rows", "n_emails", "n_lost")])


_EVENT_VALUES = "select event_id, user_id, event_type, value from events"


@query("range_source", _EVENT_VALUES)
def range_source(spark, sf):
    """The events in four ranges of ids, each of which reads the same rows whenever it is read again."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    low, high = events.agg(F.min("event_id") - 1, F.max("event_id")).first()
    cuts = [low + (high - low) * k // 4 for k in range(5)]
    return shape.union_tables(*[cursor.read_between(events, "event_id", a, b) for a, b in zip(cuts, cuts[1:])])


@query("range_source_stream", _EVENT_VALUES)
def range_source_stream(spark, sf):
    """The events landed in ranges of ids, and streamed one file after another."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    root = shared_folder(spark, "range-stream")
    events.repartitionByRange(4, "event_id").write.parquet(f"{root}/landed")
    rows = stream_table(spark, f"{root}/landed", events.schema, max_files=1)
    append_flow(rows, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    return scan_table(spark, f"{root}/data")


# -- service tables ---------------------------------------------------------------------


@query(
    "stripe_customers",
    """
select 'cus_' || c_custkey as id, 'customer' as object, c_custkey as created, c_name as name,
       n_name as address_country, null::varchar as address_city,
       case when c_acctbal >= 0 then n_name end as shipping_address_country,
       cast(trunc(c_acctbal) as bigint) as balance,
       '{"segment":"' || c_mktsegment || '"}' as metadata, null::varchar as discount,
       c_mktsegment = 'BUILDING' as deleted
from customer join nation on c_nationkey = n_nationkey""",
)
def stripe_customers(spark, sf):
    nation = table(spark, sf, "nation")
    joined = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    place = F.struct(F.col("n_name").alias("country"))
    objects = joined.select(
        F.concat(F.lit("cus_"), F.col("c_custkey").cast("string")).alias("id"),
        F.lit("customer").alias("object"),
        F.col("c_custkey").alias("created"),
        F.col("c_name").alias("name"),
        place.alias("address"),
        F.when(F.col("c_acctbal") >= 0, F.struct(place.alias("address"))).alias("shipping"),
        F.col("c_acctbal").alias("balance"),
        F.create_map(F.lit("segment"), F.col("c_mktsegment")).alias("metadata"),
        F.from_json(F.lit("{}"), "map<string,string>").alias("discount"),
        F.when(F.col("c_mktsegment") == "BUILDING", True).alias("deleted"),
    )
    rows = table_rows(as_payload(objects), CATALOG["stripe"]["customers"])
    return rows.select(
        "id", "object", "created", "name", "address_country", "address_city", "shipping_address_country",
        "balance", "metadata", "discount", "deleted",
    )


@query(
    "stripe_coupons",
    """
select p_partkey::varchar as id, p_name as name, p_size::bigint as duration_in_months,
       case when p_size % 10 <> 0 then (p_size % 10)::varchar end as percent_off,
       '{"products":["' || p_brand || '","' || p_type || '"]}' as applies_to
from part""",
)
def stripe_coupons(spark, sf):
    coupons = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_size").alias("duration_in_months"),
        F.pmod(F.col("p_size"), F.lit(10)).alias("percent_off"),
        F.struct(F.array("p_brand", "p_type").alias("products")).alias("applies_to"),
    )
    rows = table_rows(as_payload(coupons), CATALOG["stripe"]["coupons"])
    return rows.select("id", "name", "duration_in_months", "percent_off", "applies_to")


@query(
    "stripe_invoice_items",
    """
select l_orderkey || '-' || l_linenumber || '-' || l_partkey as id, cast(trunc(l_extendedprice) as bigint) as amount,
       l_orderkey::varchar as invoice, cast(l_quantity as bigint) as quantity,
       epoch(l_shipdate)::bigint as period_start, null::bigint as period_end
from lineitem""",
)
def stripe_invoice_items(spark, sf):
    start = F.struct(F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("start"))
    items = table(spark, sf, "lineitem").select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")]).alias("id"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_orderkey").alias("invoice"),
        F.col("l_quantity").alias("quantity"),
        start.alias("period"),
    )
    rows = table_rows(as_payload(items), CATALOG["stripe"]["invoice_items"])
    return rows.select("id", "amount", "invoice", "quantity", "period_start", "period_end")


@query(
    "github_issues",
    """
select o_orderkey as id, o_orderkey as number, c_mktsegment as repository_owner, c_name as repository_name,
       case when o_orderstatus = 'O' then 'open' else 'closed' end as state,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as updated_at,
       c_name as user_login, c_custkey as user_id, o_orderpriority as first_label, 1::bigint as n_labels
from orders join customer on o_custkey = c_custkey""",
)
def github_issues(spark, sf):
    joined = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    issues = joined.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("number"),
        F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"),
        iso("o_orderdate").alias("updated_at"),
        F.struct(F.col("c_name").alias("login"), F.col("c_custkey").alias("id")).alias("user"),
        F.array(F.struct(F.col("o_orderpriority").alias("name"))).alias("labels"),
        F.col("c_mktsegment").alias("owner"),
        F.col("c_name").alias("repo"),
    )
    record = F.to_json(F.struct(*[c for c in issues.columns if c not in ("owner", "repo")]))
    landed = issues.select("owner", "repo", record.alias("payload"))
    rows = table_rows(landed, CATALOG["github"]["issues"])
    return rows.select(
        "id", "number", "repository_owner", "repository_name", "state", "updated_at",
        *shaping.flatten("user", ["login", "id"]),
        F.col("labels")[0]["name"].alias("first_label"), F.size("labels").cast("bigint").alias("n_labels"),
    )


@query(
    "github_commits",
    """
select event_id::varchar as sha, event_type as commit_message, user_id::varchar as commit_author_name,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as commit_author_date, null::varchar as commit_committer_name,
       'acme' as repository_owner
from events""",
)
def github_commits(spark, sf):
    author = F.struct(F.col("user_id").cast("string").alias("name"), iso("ts").alias("date"))
    commits = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("sha"),
        F.struct(F.col("event_type").alias("message"), author.alias("author")).alias("commit"),
    )
    landed = as_payload(commits).withColumns({"owner": F.lit("acme"), "repo": F.lit("shop")})
    rows = table_rows(landed, CATALOG["github"]["commits"])
    return rows.select(
        "sha", "commit_message", "commit_author_name", "commit_author_date", "commit_committer_name", "repository_owner"
    )


@query(
    "hubspot_contacts",
    """
select c_custkey::varchar as id, c_acctbal < 0 as archived,
       coalesce(string_agg(o_orderkey::varchar, ',' order by o_orderkey), '') as companies,
       c_name as properties_name, cast(trunc(c_acctbal) as bigint) as properties_balance,
       c_mktsegment = 'MACHINERY' as properties_heavy
from customer left join orders on c_custkey = o_custkey and o_orderstatus = 'F'
group by c_custkey, c_acctbal, c_name, c_mktsegment""",
)
def hubspot_contacts(spark, sf):
    from tidemark.sources.catalog.crm import object_table

    orders = table(spark, sf, "orders").where("o_orderstatus = 'F'").groupBy("o_custkey").agg(
        F.array_sort(F.collect_list("o_orderkey")).alias("orders")
    )
    joined = table(spark, sf, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    company = F.struct(F.transform("orders", lambda o: F.struct(o.cast("string").alias("id"))).alias("results"))
    records = joined.select(
        F.col("c_custkey").cast("string").alias("id"),
        (F.col("c_acctbal") < 0).alias("archived"),
        F.when(F.col("orders").isNotNull(), F.struct(company.alias("companies"))).alias("associations"),
        F.struct(
            F.col("c_name").alias("name"),
            F.col("c_acctbal").cast("string").alias("balance"),
            (F.col("c_mktsegment") == "MACHINERY").cast("string").alias("heavy"),
        ).alias("properties"),
    )
    contacts = object_table("contacts", [("name", "string"), ("balance", "number"), ("heavy", "bool")])
    rows = table_rows(as_payload(records), contacts)
    return rows.select(
        "id", "archived", F.array_join("companies", ",").alias("companies"),
        "properties_name", "properties_balance", "properties_heavy",
    )


@query(
    "zendesk_ticket_comments",
    """select conv_id * 100 + turn as id, conv_id as event_id, conv_id as ticket_id, text as body,
              '2024-01-01T00:00:00Z' as created_at
       from conversations where role = 'user'""",
)
def zendesk_ticket_comments(spark, sf):
    """Conversations as ticket events; the turns of the user are the comments."""
    turns = table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", "Comment").otherwise("Change").alias("event_type"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"),
        F.col("text").alias("body"),
    )
    nested = shape.nest_children(turns, ["conv_id"], ["turn"], ["event_type", "id", "body"], name="child_events")
    tickets = nested.select(
        F.col("conv_id").alias("id"),
        F.col("conv_id").alias("ticket_id"),
        F.lit("2024-01-01T00:00:00Z").alias("created_at"),
        "child_events",
    )
    rows = table_rows(comment_records(as_payload(tickets)), CATALOG["zendesk"]["ticket_comments"])
    return rows.select("id", "event_id", "ticket_id", "body", "created_at")


@query(
    "github_reviews",
    """
select l_orderkey * 100000000 + l_partkey * 100 + l_linenumber as id, l_orderkey as pull_number,
       case when l_returnflag = 'A' then 'APPROVED' else 'COMMENTED' end as state, 'acme' as repository_owner,
       l_suppkey as user_id
from lineitem join orders on l_orderkey = o_orderkey""",
)
def github_reviews(spark, sf):
    """Children of every parent in one join; the parent number is landed beside the record."""
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    children = joins.expand_children(orders, lines, {"o_orderkey": "l_orderkey"}, carry={"pull_number": "o_orderkey"})
    reviews = children.select(
        (F.col("l_orderkey") * 100000000 + F.col("l_partkey") * 100 + F.col("l_linenumber")).alias("id"),
        F.when(F.col("l_returnflag") == "A", "APPROVED").otherwise("COMMENTED").alias("state"),
        F.struct(F.col("l_suppkey").alias("id")).alias("user"),
        "pull_number",
    )
    record = F.to_json(F.struct("id", "state", "user"))
    scoped = shape.with_scope(reviews, {"owner": "acme", "repo": "shop"})
    landed = scoped.select("owner", "repo", "pull_number", record.alias("payload"))
    rows = table_rows(landed, CATALOG["github"]["reviews"])
    return rows.select("id", "pull_number", "state", "repository_owner", F.col("user.id").alias("user_id"))


@query(
    "github_teams",
    """
select s_suppkey as id, n_name as organization_login, s_name as slug, r_name as name
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
)
def github_teams(spark, sf):
    """A list whose entries are expanded to their detail; the organisation comes from the list."""
    nation = table(spark, sf, "nation")
    listed = joins.expand_detail(
        table(spark, sf, "supplier"), nation, {"s_nationkey": "n_nationkey"},
        carry={"login": "n_name", "region": "n_regionkey"},
    )
    detailed = joins.expand_detail(listed, table(spark, sf, "region"), {"region": "r_regionkey"}, carry={"name": "r_name"})
    teams = detailed.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("slug"),
        "name",
        F.struct("login").alias("organization"),
    )
    rows = table_rows(as_payload(teams), CATALOG["github"]["teams"])
    return rows.select("id", "organization_login", "slug", "name")


@query(
    "issue_kinds",
    """select o_orderstatus = 'P' as is_pull_request, count(*)::bigint as n from orders group by 1""",
)
def issue_kinds(spark, sf):
    """Pull requests inside an issue list are the rows with a `pull_request` object."""
    link = F.create_map(F.lit("url"), F.lit("https://h/pulls/1"))
    issues = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("number"),
        F.when(F.col("o_orderstatus") == "P", link).alias("pull_request"),
    )
    landed = as_payload(issues).withColumns({"owner": F.lit("acme"), "repo": F.lit("shop")})
    rows = table_rows(landed, CATALOG["github"]["issues"])
    return rows.groupBy(F.col("pull_request").isNotNull().alias("is_pull_request")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "zendesk_tickets",
    """
select o_orderkey as id, o_orderpriority as priority, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as updated_at,
       o_custkey as requester_id, o_orderstatus as first_tag, 'web' as channel, 'v' || o_orderstatus as field_value
from orders""",
)
def zendesk_tickets(spark, sf):
    """Landed response pages of a hundred tickets: pages to records to typed rows to the upsert."""
    tickets = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("priority"),
        iso("o_orderdate").alias("updated_at"),
        F.col("o_custkey").cast("string").alias("requester_id"),
        F.array("o_orderstatus").alias("tags"),
        F.create_map(F.lit("channel"), F.lit("web")).alias("via"),
        F.array(F.struct(F.lit(9).alias("id"), F.concat(F.lit("v"), "o_orderstatus").alias("value"))).alias("custom_fields"),
        F.col("o_orderkey").alias("key"),
    )
    record = as_payload(tickets.drop("key").withColumn("key", F.col("id")), "key", name="record")
    bodies = paging.assign_pages(record, "key").groupBy("page").agg(F.collect_list("record").alias("records"))
    body = F.concat(F.lit('{"tickets":['), F.array_join("records", ","), F.lit('],"end_of_stream":false}'))
    definition = CATALOG["zendesk"]["tickets"]
    payloads = paging.unnest_envelope(bodies.select(body.alias("body")), "body", definition.envelope)
    current = apply_changes(table_rows(payloads, definition), definition.keys, definition.cursor)
    return current.select(
        "id", "priority", "updated_at", "requester_id", F.col("tags")[0].alias("first_tag"),
        F.col("via")["channel"].alias("channel"), F.col("custom_fields")[0]["value"].alias("field_value"),
    )


# -- many tables in one call ------------------------------------------------------------


@query(
    "ingest",
    """
select 'customer' as table_name, c_custkey as key, c_name as label from customer
union all
select 'orders', o_orderkey, o_orderstatus from orders
union all
select 'events', event_id, event_type from events""",
)
def q_ingest(spark, sf):
    """Three landed tables: a snapshot, a cdc table sent twice, and an append table sent twice."""
    root = shared_folder(spark, "ingest")
    kinds = {"customer": "c_custkey", "orders": "o_orderkey", "events": "event_id"}
    for name in kinds:
        landed = as_payload(table(spark, sf, name))
        for _ in range(1 if name == "customer" else 2):
            landed.write.mode("append").parquet(f"{root}/landed/{name}")
    tables = {
        "customer": TableDef("customer", fields("c_custkey:long! c_name c_mktsegment"), ("c_custkey",), None, SNAPSHOT),
        "orders": TableDef("orders", fields("o_orderkey:long! o_orderdate o_orderstatus"), ("o_orderkey",), "o_orderdate"),
        "events": TableDef("events", fields("event_id:long! event_type"), ("event_id",), None, APPEND),
    }
    spec = {
        "connection_name": "landed",
        "objects": [{"table": {"source_table": n, "table_configuration": {"max_files": 4}}} for n in tables],
    }
    done = ingest(spark, LandedSource(f"{root}/landed", tables), spec, f"{root}/target", run_id=1)
    labels = {"customer": "c_name", "orders": "o_orderstatus", "events": "event_type"}
    parts = [
        done[n].read(spark).select(F.lit(n).alias("table_name"), F.col(k).alias("key"), F.col(labels[n]).alias("label"))
        for n, k in kinds.items()
    ]
    return shape.union_tables(*parts)


# -- more service tables: one query for each shape of keys and columns ---------------------


@query(
    "github_branches",
    """
select 'acme' as repository_owner, p_brand as repository_name, p_name || '#' || p_partkey as name,
       'c' || p_partkey as commit_sha, p_size % 2 = 0 as protected
from part""",
)
def github_branches(spark, sf):
    """A composite key of two scope columns and the name; each branch is landed in two states."""
    part = table(spark, sf, "part")
    records = part.select(
        F.concat_ws("#", "p_name", "p_partkey").alias("name"),
        F.struct(F.concat(F.lit("c"), "p_partkey").alias("sha")).alias("commit"),
        (F.pmod("p_size", F.lit(2)) == 0).alias("protected"),
        F.col("p_brand").alias("repo"),
    )
    landed = as_payload(records, "repo").withColumn("owner", F.lit("acme"))
    definition = CATALOG["github"]["branches"]
    new = table_rows(landed, definition)
    old = new.where("protected").withColumn("protected", F.lit(False))
    current = apply_snapshot(old, new, definition.keys)
    return current.select("repository_owner", "repository_name", "name", F.col("commit.sha").alias("commit_sha"), "protected")


@query(
    "github_repositories",
    """
select p_partkey as id, 'o' || p_size as repository_owner, p_name as repository_name, 'o' || p_size as owner_login,
       p_retailprice > 1000 as private, p_partkey * 3 as size, 2::bigint as n_topics
from part""",
)
def github_repositories(spark, sf):
    owner = F.concat(F.lit("o"), "p_size")
    records = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.struct(owner.alias("login")).alias("owner"),
        (F.col("p_retailprice") > 1000).alias("private"), (F.col("p_partkey") * 3).alias("size"),
        F.array("p_brand", "p_type").alias("topics"),
    )
    rows = table_rows(as_payload(records), CATALOG["github"]["repositories"])
    return rows.select(
        "id", "repository_owner", "repository_name", F.col("owner.login").alias("owner_login"), "private", "size",
        F.size("topics").cast("bigint").alias("n_topics"),
    )


@query(
    "stripe_charges",
    """
select 'ch_' || o_orderkey as id, cast(trunc(o_totalprice * 100) as bigint) as amount, o_orderstatus = 'F' as captured,
       epoch(o_orderdate)::bigint as created, '{"priority":"' || o_orderpriority || '"}' as metadata
from orders""",
)
def stripe_charges(spark, sf):
    records = table(spark, sf, "orders").select(
        F.concat(F.lit("ch_"), "o_orderkey").alias("id"),
        F.expr("cast(o_totalprice * 100 as bigint)").alias("amount"),
        F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("captured"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string").alias("created"),
        F.struct(F.col("o_orderpriority").alias("priority")).alias("metadata"),
    )
    rows = table_rows(as_payload(records), CATALOG["stripe"]["charges"])
    return rows.select("id", "amount", "captured", "created", "metadata")


@query(
    "zendesk_organizations",
    """
select s_suppkey as id, s_name as name, 2::bigint as n_domains, n_name as tag, 'v' as first_field
from supplier join nation on s_nationkey = n_nationkey""",
)
def zendesk_organizations(spark, sf):
    joined = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    records = joined.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.array(F.lit("a.example"), "s_name").alias("domain_names"),
        F.array("n_name").alias("tags"), F.struct(F.lit("v").alias("k")).alias("organization_fields"),
    )
    rows = table_rows(as_payload(records), CATALOG["zendesk"]["organizations"])
    return rows.select(
        "id", "name", F.size("domain_names").cast("bigint").alias("n_domains"), F.col("tags")[0].alias("tag"),
        F.col("organization_fields")["k"].alias("first_field"),
    )


@query(
    "hubspot_deals",
    """
select o_orderkey::varchar as id, cast(trunc(o_totalprice) as bigint) as properties_amount, o_custkey::varchar as contacts,
       '' as companies, string_agg(l_partkey::varchar, ',' order by l_partkey, l_linenumber) as tickets
from orders join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_totalprice, o_custkey""",
)
def hubspot_deals(spark, sf):
    """Three associations, one of which is never there."""
    from tidemark.sources.catalog.crm import object_table

    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_partkey", "l_linenumber"))).alias("lines")
    )
    joined = table(spark, sf, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    ids = lambda a: F.struct(a.alias("results"))
    one = F.array(F.struct(F.col("o_custkey").cast("string").alias("id")))
    many = F.transform("lines", lambda x: F.struct(x["l_partkey"].cast("string").alias("id")))
    records = joined.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.struct(ids(one).alias("contacts"), ids(many).alias("tickets")).alias("associations"),
        F.struct(F.col("o_totalprice").cast("string").alias("amount")).alias("properties"),
    )
    rows = table_rows(as_payload(records), object_table("deals", [("amount", "number")]))
    joined_ids = [F.array_join(c, ",").alias(c) for c in ("contacts", "companies", "tickets")]
    return rows.select("id", "properties_amount", *joined_ids)


@query(
    "snapshot_replay",
    _SNAPSHOTS
    + """
select o.o_custkey, o.o_orderkey, 1::bigint as start_at,
       case when n.o_custkey is null or o.o_orderkey <> n.o_orderkey
              or o.o_orderstatus is distinct from n.o_orderstatus
              or o.o_totalprice is distinct from n.o_totalprice then 2::bigint end as end_at
from o left join n on o.o_custkey = n.o_custkey
union all
select n.o_custkey, n.o_orderkey, 2::bigint, null
from n left join o on o.o_custkey = n.o_custkey
where o.o_custkey is null or o.o_orderkey <> n.o_orderkey
   or o.o_orderstatus is distinct from n.o_orderstatus or o.o_totalprice is distinct from n.o_totalprice""",
)
def snapshot_replay(spark, sf):
    """A snapshot run that is sent again, with other rows even, counts once."""
    old, new = _two_snapshots(spark, sf)
    target = TargetTable(spark, shared_folder(spark, "replay"), "o_custkey", scd_type=2)
    for rows, run in ((old, 1), (new, 2), (old, 2)):
        target.replace(rows, run)
    return target.read().select("o_custkey", "o_orderkey", F.col(START).alias("start_at"), F.col(END).alias("end_at"))


@query(
    "conform_rejects",
    """
select event_id, event_id % 7 = 0 or event_type is null as bad,
       case when event_id % 7 <> 0 then event_id end as n
from events""",
)
def conform_rejects(spark, sf):
    """Records of which every seventh holds no number where one must be; the others pass."""
    value = F.when(F.pmod("event_id", F.lit(7)) == 0, "x").otherwise(F.col("event_id").cast("string"))
    records = table(spark, sf, "events").select("event_id", value.alias("n"), F.col("event_type").alias("kind"))
    rows = table_rows(as_payload(records), TableDef("t", fields("event_id:long! n:long kind!"), ("event_id",), "n"), mode="permissive")
    return rows.select("event_id", (F.size("_errors") > 0).alias("bad"), "n")


@query(
    "contract_conform",
    """
with t as (select event_id, event_id % 7 = 0 or event_type is null as bad, ts from events),
c as (select count(*) n, count(*) filter (bad) bad, epoch(date_trunc('second', max(ts)))::bigint top from t)
select 't' as "table", 'has_offset' as "check", 'passed' as status, top as value from c
union all select 't', 'has_rows', 'passed', n from c
union all select 't', 'rows_conform', case when bad = 0 then 'passed' else 'failed' end, bad from c
union all select 't', 'key_not_null', 'passed', 0 union all select 't', 'key_unique', 'passed', 0
union all select 't', 'cursor_not_null', 'passed', 0""",
)
def contract_conform(spark, sf):
    """The checks of a read whose records hold bad values: how many rows don't conform, and the offset that it ends at."""
    value = F.when(F.pmod("event_id", F.lit(7)) == 0, "x").otherwise(F.col("event_id").cast("string"))
    records = table(spark, sf, "events").select("event_id", value.alias("n"), F.col("event_type").alias("kind"), iso("ts").alias("at"))
    definition = TableDef("t", fields("event_id:long! n:long kind! at"), ("event_id",), "at")
    rows = table_rows(as_payload(records), definition, mode="permissive")
    checks = shape.union_tables(contract.table_checks(rows, definition), contract.offset_check(rows, definition))
    return checks.select("table", "check", "status", "value")


@query("ingest_batches_of_rows", "select o_orderkey as id, o_orderstatus as label, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as updated_at from orders")
def ingest_batches_of_rows(spark, sf):
    """Two runs under a service's page limits; between them rows come late, by less than the lookback, and newer ones."""
    root = shared_folder(spark, "ingest-rows")
    records = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("label"), iso("o_orderdate").alias("updated_at")
    )
    late = records.where("id % 2 = 1 and updated_at < '1995-06-01'")
    early = records.where("not (id % 2 = 1 and updated_at < '1995-06-01')")
    definition = TableDef("rows_of_orders", fields("id:long! label updated_at"), ("id",), "updated_at")
    source = LandedSource(f"{root}/landed", {definition.name: definition})
    days = 20 * 366 * 86400
    options = {"per_page": "100", "max_pages_per_batch": "50", "lookback_seconds": str(days)}
    for part in (early, late):
        as_payload(part, "updated_at").write.mode("append").parquet(f"{root}/landed/rows_of_orders")
        done = ingest(spark, source, {definition.name: options}, f"{root}/target", run_id=1)
    return done[definition.name].read(spark)


@query(
    "ingest_options",
    """
select o_orderkey as id, o_orderstatus as label from orders
where o_orderdate >= timestamp '1995-01-01' and o_custkey % 2 = 1 and o_orderstatus <> 'P'""",
)
def ingest_options(spark, sf):
    """One table with a start, a scope, an archived flag and a transform hook."""
    root = shared_folder(spark, "ingest-options")
    records = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.lower("o_orderstatus").alias("label"), iso("o_orderdate").alias("updated_at"),
        (F.col("o_orderstatus") == "P").alias("archived"),
        F.when(F.col("o_custkey") % 2 == 1, "acme").otherwise("other").alias("owner"), F.lit("shop").alias("repo"),
    )
    as_payload(records, "owner", "repo").write.parquet(f"{root}/landed/options_of_orders")
    definition = TableDef(
        "options_of_orders", fields("id:long! label updated_at archived:boolean"), ("id",), "updated_at",
        required=("owner", "repo"), archived=True,
    )
    shape.register_shape("options_of_orders", lambda df: df.withColumn("label", F.upper("label")))
    options = {"owner": "acme", "repo": "shop", "start_date": "1995-01-01T00:00:00Z"}
    source = LandedSource(f"{root}/landed", {definition.name: definition})
    done = ingest(spark, source, {definition.name: options}, f"{root}/target", run_id=1)
    return done[definition.name].read(spark).select("id", "label")


@query(
    "conform_empty_object",
    """
select event_id, event_id % 4 = 0 as bad, case when event_id % 4 > 1 then event_type end as kind from events""",
)
def conform_empty_object(spark, sf):
    """An object without members is an error, null is none."""
    user = (
        F.when(F.pmod("event_id", F.lit(4)) == 0, "{}").when(F.pmod("event_id", F.lit(4)) == 1, "null")
        .otherwise(F.to_json(F.struct(F.col("event_type").alias("kind"))))
    )
    records = table(spark, sf, "events").select(F.format_string('{"event_id":%d,"user":%s}', "event_id", user).alias("payload"))
    schema = fields("event_id:long! user:user", {"user": fields("kind")})
    rows = conform(records, "payload", schema, mode="permissive")
    return rows.select("event_id", (F.size("_errors") > 0).alias("bad"), F.col("user.kind").alias("kind"))


@query(
    "table_samples",
    """
select 'customer' as "table", least(count(*), 3) as n from customer
union all select 'events', least(count(*), 3) from events
union all select 'orders', least(count(*), 3) from orders""",
)
def table_samples(spark, sf):
    """How many rows the sample of each table has, all of them rows of the table."""
    counts = []
    for name, key in (("customer", "c_custkey"), ("events", "event_id"), ("orders", "o_orderkey")):
        rows = table(spark, sf, name)
        taken = contract.sample_rows(rows.select(key)).join(rows.select(key), key, "left_semi")
        counts.append(taken.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n"))
    return shape.union_tables(*counts)


service_tables.register(query)
