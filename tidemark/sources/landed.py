"""Tables landed as raw records in files, read in batch or as a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import TableDef, flag
from tidemark.functions.convert import iso_minus_seconds
from tidemark.operators.cursor import scan_since
from tidemark.operators.filters import exclude_archived, scan_scope, state_filter
from tidemark.operators.paging import batch_rows, bounded_batch, unnest_envelope
from tidemark.operators.shape import shape
from tidemark.sources.records import comment_records, table_rows

PAYLOAD = T.StructType().add("payload", T.StringType())


def scan_table(
    spark: SparkSession, path: str, *, format: str = "parquet", schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """Batch scan of landed files; every file split is a task."""
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    format: str = "parquet",
    max_files: int | None = None,
    max_bytes: str | None = None,
    **options: str,
) -> DataFrame:
    """Stream of landed files. The checkpoint of the query that reads it holds the offsets,
    so a restart goes on where the last run ended. The caps bound one micro-batch."""
    reader = spark.readStream.format(format).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def staging_view(df: DataFrame, table: str) -> str:
    """Name of the temporary view `<table>_staging` over the rows about to be applied."""
    name = f"{table}_staging"
    df.createOrReplaceTempView(name)
    return name


class LandedSource:
    """A `TableSource` over `<root>/<table>/` folders of landed records.

    A folder holds a `payload` column with one JSON record (or, with the option
    `envelope=true`, one response body) per row, and may hold plain columns beside it:
    the scope columns, and the cursor. Bounds on those reach the file scan.

    Options: `start_date` (no row before it), `lookback_seconds` (a stored mark of ISO text is moved back so far),
    `owner`, `repo`, `org`, `pull_number` (scope), `state`, `archived`, `envelope`, `max_files` (files of a micro-batch),
    and `per_page` with `max_pages_per_batch` (rows of a batch read, the earliest by the cursor). Yes or no options may be
    true, yes, 1 or false, no, 0. A table's hook (`register_shape`) is applied last.
    """

    def __init__(
        self,
        root: str,
        tables: Mapping[str, TableDef],
        *,
        format: str = "parquet",
        landed_schema: T.StructType | None = None,
        mode: str = "fail",
    ):
        self.root = root.rstrip("/")
        self.tables = dict(tables)
        self.format = format
        self.landed_schema = landed_schema
        self.mode = mode

    def list_tables(self) -> list[str]:
        return sorted(self.tables)

    def table(self, name: str, options: Mapping[str, str] | None = None) -> TableDef:
        if name not in self.tables:
            raise ValueError(f"unknown table {name!r}")
        return self.tables[name]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, spark: SparkSession, name: str, since=None, options: Mapping[str, str] | None = None) -> DataFrame:
        options, table = dict(options or {}), self.table(name)
        raw = scan_table(spark, self.path(name), format=self.format, schema=self.landed_schema)
        cursor, start = table.cursor, options.get("start_date")
        if since and "lookback_seconds" in options:
            moved = iso_minus_seconds(F.lit(str(since)), int(options["lookback_seconds"]))
            since = raw.sparkSession.range(1).select(moved).first()[0]
        pushed = cursor is not None and cursor in raw.columns
        if pushed:
            raw = scan_since(raw, cursor, since, start)
        rows = self._rows(raw, table, options)
        if not pushed and cursor is not None:
            rows = scan_since(rows, cursor, since, start)
        if cursor is not None and ("per_page" in options or "max_pages_per_batch" in options):
            cap = batch_rows(options.get("per_page"), options.get("max_pages_per_batch"))
            rows = bounded_batch(rows, [cursor, *[k for k in table.keys if k != cursor]], cap)
        return rows

    def read_stream(self, spark: SparkSession, name: str, options: Mapping[str, str] | None = None) -> DataFrame:
        options, table = dict(options or {}), self.table(name)
        schema = self.landed_schema or spark.read.format(self.format).load(self.path(name)).schema
        cap = options.get("max_files")
        raw = stream_table(
            spark, self.path(name), schema, format=self.format, max_files=int(cap) if cap else None
        )
        start, pushed = options.get("start_date"), table.cursor in raw.columns
        if table.cursor is not None and pushed:
            raw = scan_since(raw, table.cursor, None, start)
        rows = self._rows(raw, table, options)
        return rows if pushed or table.cursor is None else scan_since(rows, table.cursor, None, start)

    def _rows(self, raw: DataFrame, table: TableDef, options: Mapping[str, str]) -> DataFrame:
        scope = {c: options[c] for c in ("owner", "repo", "org", "pull_number") if c in options}
        lost = [c for c in scope if c not in raw.columns]
        if lost:
            raise ValueError(f"{table.name}: no landed column for the scope {', '.join(lost)}")
        raw = scan_scope(raw, scope, required=table.required, exactly_one_of=table.one_of)
        beside = [c for c in raw.columns if c != "payload"]
        if flag(options, "envelope", False):
            raw = unnest_envelope(raw, "payload", table.envelope, keep=beside)
        if table.events:
            raw = comment_records(raw, keep=beside)
        rows = table_rows(raw, table, mode=self.mode)
        if "state" in options and "state" in rows.columns:
            rows = state_filter(rows, "state", options["state"])
        if "archived" in rows.columns and not flag(options, "archived", not table.archived):
            rows = exclude_archived(rows)
        return shape(rows, table.name)
