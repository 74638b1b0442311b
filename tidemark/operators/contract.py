"""Contract checks as one report DataFrame: table, check, status, value."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.conform import ERRORS
from tidemark.functions.convert import epoch_seconds
from tidemark.model import APPEND, CDC, MODES, SNAPSHOT, TableDef

PASSED, FAILED, ERROR = "passed", "failed", "error"
_DEFINITION = (
    "table string, columns array<struct<name: string, type: string>>, "
    "primary_key array<string>, cursor_field string, mode string"
)


def _status(ok: Column) -> Column:
    """Passed or failed; a test that gives NULL could not be made."""
    return F.when(ok.isNull(), ERROR).when(ok, PASSED).otherwise(FAILED)


def _long_form(df: DataFrame, checks: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Named (test, value) pairs of one-row-per-table frames to one row per check."""
    rows = [
        F.struct(F.lit(n).alias("check"), _status(ok).alias("status"), value.cast("bigint").alias("value"))
        for n, (ok, value) in checks.items()
    ]
    return df.select("table", F.explode(F.array(*rows)).alias("__r")).select("table", "__r.*")


def definition_checks(spark: SparkSession, tables: Iterable[TableDef]) -> DataFrame:
    """Checks on the definitions alone: names, types, keys and cursor."""
    rows = [
        (
            t.name,
            [(f.name, f.dataType.simpleString()) for f in t.schema.fields],
            list(t.keys),
            t.cursor,
            t.ingestion_mode,
        )
        for t in tables
    ]
    frame = spark.createDataFrame(rows, _DEFINITION)
    names = F.transform("columns", lambda c: c["name"])
    narrow = F.filter("columns", lambda c: c["type"] == "int")
    lost_keys = F.size(F.array_except("primary_key", names))
    keyed = F.col("mode") == APPEND
    has_cursor = F.col("mode").isin(SNAPSHOT, APPEND) | F.col("cursor_field").isNotNull()
    found_cursor = F.col("cursor_field").isNull() | F.array_contains(names, F.col("cursor_field"))
    return _long_form(
        frame,
        {
            "name_given": (F.length("table") > 0, F.length("table")),
            "schema_given": (F.size("columns") > 0, F.size("columns")),
            "no_narrow_integer": (F.size(narrow) == 0, F.size(narrow)),
            "mode_known": (F.col("mode").isin(*MODES), F.lit(None)),
            "key_given": (keyed | (F.size("primary_key") > 0), F.size("primary_key")),
            "key_in_schema": (lost_keys == 0, lost_keys),
            "cursor_given": (has_cursor, F.lit(None)),
            "cursor_in_schema": (found_cursor, F.lit(None)),
        },
    )


def key_uniqueness(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def table_checks(df: DataFrame, table: TableDef) -> DataFrame:
    """Checks on all rows of a table, in one pass over its key, cursor and error columns.

    Rows are counted per key before the shuffle, so a heavily repeated key is no burden.
    """
    keys = list(table.keys)
    cursor = F.col(f"`{table.cursor}`") if table.cursor else None
    no_key = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys]) if keys else F.lit(False)
    bad = (F.size(ERRORS) > 0) if ERRORS in df.columns else F.lit(False)
    lost = cursor.isNull() if cursor is not None else F.lit(False)
    rows = df.select(*[F.col(f"`{k}`") for k in keys], no_key.alias("__no_key"), bad.alias("__bad"), lost.alias("__lost"))
    per_key = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("__no_key").alias("no_key"),
        F.count_if("__bad").alias("bad"),
        F.count_if("__lost").alias("lost"),
    )
    repeated = F.count_if(F.col("n") > 1) if keys else F.lit(0)
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("no_key"), F.lit(0)).alias("no_key"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
        F.coalesce(F.sum("lost"), F.lit(0)).alias("lost"),
        repeated.alias("repeated"),
    ).withColumn("table", F.lit(table.name))
    checks = {
        "has_rows": (F.col("rows") > 0, F.col("rows")),
        "rows_conform": (F.col("bad") == 0, F.col("bad")),
    }
    if keys:
        checks["key_not_null"] = (F.col("no_key") == 0, F.col("no_key"))
        checks["key_unique"] = (F.col("repeated") == 0, F.col("repeated"))
    if cursor is not None:
        checks["cursor_not_null"] = (F.col("lost") == 0, F.col("lost"))
    return _long_form(totals, checks)


def offset_check(df: DataFrame, table: TableDef) -> DataFrame:
    """Whether the read ends at an offset: the highest cursor, as a number or in epoch seconds. Tables without a cursor need none."""
    if table.cursor is None:
        frame = df.sparkSession.createDataFrame([(table.name,)], "table string")
        return _long_form(frame, {"has_offset": (F.lit(True), F.lit(None))})
    top = df.agg(F.max(f"`{table.cursor}`").cast("string").alias("top")).withColumn("table", F.lit(table.name))
    shown = F.coalesce(F.col("top").try_cast("bigint"), epoch_seconds("top"))
    return _long_form(top, {"has_offset": (F.col("top").isNotNull(), shown)})


def increment_check(table: TableDef, before: DataFrame, after: DataFrame, written: int = 1) -> DataFrame:
    """After a write of `written` rows: a snapshot grew by just that, other modes return some row.

    `before` is the earlier snapshot; for cdc and append it is not looked at and `after` is
    the incremental read.
    """
    counted = after.agg(F.count(F.lit(1)).alias("after"))
    if table.ingestion_mode == SNAPSHOT:
        side = before.agg((-F.count(F.lit(1))).alias("after"))
        counted = counted.union(side).agg(F.sum("after").alias("after"))
        ok = F.col("after") == written
    else:
        ok = F.col("after") >= 1
    return _long_form(counted.withColumn("table", F.lit(table.name)), {"increment": (ok, F.col("after"))})


def contract_report(spark: SparkSession, tables: Iterable[tuple[TableDef, DataFrame]]) -> DataFrame:
    """All checks of all tables."""
    tables = list(tables)
    parts = [definition_checks(spark, [t for t, _ in tables])] + [table_checks(df, t) for t, df in tables]
    return reduce(DataFrame.unionByName, parts)


def report_summary(report: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Counts by status, success rate in percent (0 without checks), and the worst status."""
    severity = F.when(F.col("status") == ERROR, 2).when(F.col("status") == FAILED, 1).otherwise(0)
    total = F.count(F.lit(1))
    passed = F.count_if(F.col("status") == PASSED)
    return report.groupBy(*by).agg(
        total.alias("total"),
        passed.alias("passed"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.count_if(F.col("status") == ERROR).alias("errors"),
        F.when(total == 0, F.lit(0.0)).otherwise(100.0 * passed / total).alias("success_rate"),
        F.coalesce(F.max_by("status", severity), F.lit(PASSED)).alias("status"),
    )


def sample_rows(df: DataFrame, n: int = 3) -> DataFrame:
    """A few rows to look at."""
    return df.limit(n)
