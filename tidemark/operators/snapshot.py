"""Snapshot flows: difference, replacement and history between full snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.shaping import fail_on
from tidemark.operators.changes import END, START
from tidemark.operators.ordered import null_safe

CHANGE = "change_type"


def _names(value: Sequence[str] | str) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def _paired(old: DataFrame, new: DataFrame, keys: list[str], compared: Sequence[str] | None) -> DataFrame:
    """Both snapshots by key as structs `__old`, `__new`, with the change type. A key that one of them repeats fails the job.

    The rows are grouped rather than joined: a repeated key never makes pairs.
    """
    compared = [c for c in (compared or new.columns) if c not in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(f"`{k}`").alias(f"__k_{k}") for k in keys], F.struct("*").alias(name))

    both = side(old, "__old").unionByName(side(new, "__new"), allowMissingColumns=True)
    grouped = both.groupBy(*[f"__k_{k}" for k in keys]).agg(
        *[F.first(s, ignorenulls=True).alias(s) for s in ("__old", "__new")],
        *[F.count(s).alias(f"__n{s}") for s in ("__old", "__new")],
    )
    shown = F.to_json(F.struct(*[F.col(f"__k_{k}").alias(k) for k in keys]))
    repeated = F.greatest("__n__old", "__n__new") > 1
    grouped = fail_on(grouped, F.when(repeated, F.concat(F.lit("key is not unique in a snapshot: "), shown)))
    same = F.lit(True)
    for c in compared:
        # The values themselves are compared: two rows with one hash could differ.
        before = F.col(f"__old.`{c}`") if c in old.columns else F.lit(None)
        same = same & before.eqNullSafe(F.col(f"__new.`{c}`"))
    change = (
        F.when(F.col("__old").isNull(), "insert")
        .when(F.col("__new").isNull(), "delete")
        .when(same, "same")
        .otherwise("update")
    )
    return grouped.withColumn(CHANGE, change)


def snapshot_diff(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str] | str,
    *,
    compared: Sequence[str] | None = None,
    include_same: bool = False,
) -> DataFrame:
    """One row per key that was inserted, updated or deleted, with its change type.

    A row shows the new values, or the old ones for a deleted key. Keys must be
    unique in each snapshot and may be NULL.
    """
    keys = _names(keys)
    paired = _paired(old, new, keys, compared)
    if not include_same:
        paired = paired.where(F.col(CHANGE) != "same")

    def shown(c: str):
        before = F.col(f"__old.`{c}`") if c in old.columns else F.lit(None)
        return F.when(F.col("__new").isNull(), before).otherwise(F.col(f"__new.`{c}`"))

    return paired.select(*[shown(c).alias(c) for c in new.columns], CHANGE)


def apply_snapshot(
    stored: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str] | str,
    *,
    complete: bool = True,
    scd_type: int | str = 1,
    version=None,
    compared: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of the target after a new snapshot.

    complete   False for a snapshot that was cut short: its rows are taken in, and no
               key vanishes because it was not seen.
    scd_type   1: the current rows. 2: history with `__start_at` / `__end_at` set to
               `version`; `stored` is the history so far.
    """
    keys = _names(keys)
    if not keys:
        raise ValueError("a snapshot flow needs key columns")
    scd = str(scd_type).upper().removeprefix("SCD_TYPE_")
    if scd == "1":
        if complete:
            return snapshot
        marks = snapshot.select(*[F.col(f"`{k}`").alias(f"__s_{k}") for k in keys])
        unseen = stored.join(marks, null_safe(stored, marks, keys, "__s_"), "left_anti")
        return snapshot.unionByName(unseen, allowMissingColumns=True)
    if scd != "2":
        raise ValueError(f"unknown scd_type {scd_type!r}")
    if version is None:
        raise ValueError("snapshot history needs a version")

    now = version if not isinstance(version, (int, str)) else F.lit(version)
    now = now.cast(stored.schema[START].dataType)
    columns = [c for c in stored.columns if c not in (START, END)]
    closed = stored.where(F.col(END).isNotNull())
    paired = _paired(stored.where(F.col(END).isNull()), snapshot, keys, compared)
    ends = F.col(CHANGE).isin("update", "delete") if complete else F.col(CHANGE) == "update"

    def row(side: str, frame: DataFrame, start, end):
        values = [
            (F.col(f"{side}.`{c}`") if c in frame.columns else F.lit(None).cast(stored.schema[c].dataType)).alias(c)
            for c in columns
        ]
        return F.struct(*values, start.alias(START), end.alias(END))

    end_type = stored.schema[END].dataType
    never = F.lit(None).cast(end_type)
    old_row = row("__old", stored, F.col(f"__old.{START}"), F.when(ends, now.cast(end_type)))
    new_row = row("__new", snapshot, now, never)
    # One pass over the join: a changed key gives its closed and its new row.
    rows = F.array_compact(
        F.array(
            F.when(F.col("__old").isNotNull(), old_row),
            F.when(F.col(CHANGE).isin("insert", "update"), new_row),
        )
    )
    opened = paired.select(F.explode(rows).alias("__row")).select("__row.*")
    return closed.unionByName(opened)


def open_history(snapshot: DataFrame, version) -> DataFrame:
    """First snapshot as history: every row open since `version`."""
    start = F.lit(version) if isinstance(version, (int, str)) else version
    return snapshot.withColumn(START, start).withColumn(END, F.lit(None).cast(snapshot.select(start).schema[0].dataType))
