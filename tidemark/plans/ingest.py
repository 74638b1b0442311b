"""Declarative ingestion: one call keeps many tables of a source up to date."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.model import APPEND, CDC, TableDef, TableSource, flag, requested_tables, text_options
from tidemark.plans.target import TargetTable
from tidemark.sources.landed import staging_view
from tidemark.operators.paging import batch_rows
from tidemark.streaming.flows import BATCH, append_batch, append_flow, upsert_stream
from tidemark.streaming.keyset import drain

# Fixed value: how far a run looks back unless told otherwise.
LOOKBACK_SECONDS = 300


@dataclass
class Ingested:
    table: TableDef
    target: TargetTable | None
    path: str
    query: StreamingQuery | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop(BATCH) if self.target is None else self.target.read()


def ingest(
    spark: SparkSession,
    source: TableSource,
    spec: Mapping[str, object],
    target_root: str,
    *,
    run_id: int,
    wait: bool = True,
) -> dict[str, Ingested]:
    """Bring every table in the spec up to date, each by its mode.

    `spec` is `{"connection_name", "objects": [{"table": {"source_table",
    "table_configuration"}}]}`, or a mapping table name -> options. All definitions are
    checked before anything runs; then one query per table is started, each in its own
    scheduler pool, and snapshots are refreshed beside them. With `per_page`, `max_pages_per_batch` or `lookback_seconds` a change or
    append table is read in batches of that many rows by cursor and key, and each run looks back for late rows. `run_id` numbers a snapshot refresh:
    repeat it after a failure, and take a new one for a new run.
    """
    if "objects" in spec or "connection_name" in spec:
        tables = requested_tables(spec)
    else:
        tables = {name: text_options(options) for name, options in spec.items()}
    plan = {}
    for name, options in tables.items():
        table = source.table(name, options)
        table.check()
        plan[name] = (table, options)

    done: dict[str, Ingested] = {}
    pool = "spark.scheduler.pool"

    def start(name: str) -> Ingested:
        table, options = plan[name]
        spark.sparkContext.setLocalProperty(pool, f"ingest-{name}")
        try:
            return _start(spark, source, table, options, f"{target_root.rstrip('/')}/{name}", run_id)
        finally:
            spark.sparkContext.setLocalProperty(pool, None)

    for name, (table, options) in plan.items():
        if table.ingestion_mode in (APPEND, CDC) and not _by_rows(table, options):
            done[name] = start(name)
    snapshots = [name for name in plan if name not in done]
    if snapshots:
        with ThreadPoolExecutor(len(snapshots)) as threads:
            done |= dict(zip(snapshots, threads.map(start, snapshots), strict=True))
    done = {name: done[name] for name in plan}
    if wait:
        for result in done.values():
            if result.query is not None:
                result.query.awaitTermination()
    return done


def _by_rows(table: TableDef, options: Mapping) -> bool:
    """Whether a change or append table is read in batches of rows: page limits or a lookback ask for it."""
    asked = any(o in options for o in ("per_page", "max_pages_per_batch", "lookback_seconds"))
    return asked and table.cursor is not None and table.ingestion_mode in (APPEND, CDC)


def _drain(spark: SparkSession, source: TableSource, table: TableDef, options: Mapping, root: str, apply, prepare=None) -> None:
    limits = ("per_page", "max_pages_per_batch", "lookback_seconds")
    plain = {k: v for k, v in options.items() if k not in limits}
    back = options.get("lookback_seconds", LOOKBACK_SECONDS)
    cap = batch_rows(options.get("per_page"), options.get("max_pages_per_batch"))
    if not cap:
        return
    read = lambda since: source.read(spark, table.name, since, plain)
    drain(spark, read, table.cursor, table.keys, cap, apply, f"{root}/marks", lookback=int(back), prepare=prepare)


def _start(
    spark: SparkSession, source: TableSource, table: TableDef, options: dict, root: str, run_id: int
) -> Ingested:
    mode, checkpoint = table.ingestion_mode, f"{root}/checkpoint"
    if mode == APPEND and _by_rows(table, options):
        _drain(spark, source, table, options, root, lambda rows, n: append_batch(rows, f"{root}/data", list(table.keys), f"rows-{n}"))
        return Ingested(table, None, f"{root}/data")
    if mode == APPEND:
        rows = source.read_stream(spark, table.name, options)
        query = append_flow(rows, f"{root}/data", checkpoint, keys=table.keys or None)
        return Ingested(table, None, f"{root}/data", query)
    target = TargetTable(
        spark,
        f"{root}/data",
        table.keys,
        [table.cursor] if mode == CDC else [],
        scd_type=options.get("scd_type", "1"),
        apply_as_deletes=options.get("apply_as_deletes"),
    )
    if mode == CDC and _by_rows(table, options):
        prepare = None if target.scd == "2" else lambda rows, number, last: target.prepare(rows, number, "rows", last=last)
        _drain(spark, source, table, options, root, lambda rows, n: target.upsert(rows, n, "rows"), prepare)
        return Ingested(table, target, f"{root}/data")
    if mode == CDC:
        rows = source.read_stream(spark, table.name, options)
        return Ingested(table, target, f"{root}/data", upsert_stream(rows, target, checkpoint))
    snapshot = source.read(spark, table.name, None, options)
    staging_view(snapshot, table.name)
    target.replace(snapshot, run_id, complete=flag(options, "complete", True))
    return Ingested(table, target, f"{root}/data")
