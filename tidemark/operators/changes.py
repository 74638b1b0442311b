"""Change-data flows: current state (SCD 1) and history (SCD 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key
from tidemark.operators.ordered import CHUNK, in_chunks, neighbours, null_safe

START, END, DELETED = "__start_at", "__end_at", "__deleted"


def _names(value: Sequence[str] | str) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def apply_changes(
    changes: DataFrame,
    keys: Sequence[str] | str,
    sequence_by: Sequence[str] | str,
    *,
    stored: DataFrame | None = None,
    scd_type: int | str = 1,
    apply_as_deletes: Column | str | None = None,
    tracked: Sequence[str] | None = None,
    keep_tombstones: bool = False,
    pieces: int | None = None,
) -> DataFrame:
    """Rows of the target after a set of changes.

    scd_type 1  the latest row per key. `stored` is the target so far; an older
                change never beats it.
    scd_type 2  one row per value a key ever had, with `__start_at` and `__end_at`
                taken from the first sequence column (`__end_at` NULL = current).
                Consecutive equal rows are one row. `stored` is the earlier change
                log, not the history: a late change can bring back a row that was
                folded away before.
    apply_as_deletes  predicate on a change row. Such a row removes its key (type 1)
                or closes its open row (type 2). Without it a flag such as `deleted`
                is data like any other column.
    keep_tombstones  type 1: keep removed keys with `__deleted = true`, so that a
                later, older change does not bring them back.
    """
    keys, sequence = _names(keys), _names(sequence_by)
    if not keys:
        raise ValueError("a change flow needs key columns")
    if not sequence:
        raise ValueError("a change flow needs a cursor column to order the changes")
    scd = str(scd_type).upper().removeprefix("SCD_TYPE_")
    if scd not in ("1", "2"):
        raise ValueError(f"unknown scd_type {scd_type!r}")

    if apply_as_deletes is not None:
        gone = F.expr(apply_as_deletes) if isinstance(apply_as_deletes, str) else apply_as_deletes
        changes = changes.withColumn(DELETED, F.coalesce(gone, F.lit(False)))
    if stored is not None:
        changes = stored.unionByName(changes, allowMissingColumns=True)
    if scd == "2":
        return _history(changes, keys, sequence, tracked, pieces)

    current = latest_per_key(changes, keys, sequence)
    if DELETED in current.columns:
        current = current.withColumn(DELETED, F.coalesce(DELETED, F.lit(False)))
        if not keep_tombstones:
            current = current.where(~F.col(DELETED)).drop(DELETED)
    return current


def _history(
    changes: DataFrame,
    keys: list[str],
    sequence: list[str],
    tracked: Sequence[str] | None,
    pieces: int | None,
) -> DataFrame:
    columns = [c for c in changes.columns if c != DELETED]
    if DELETED not in changes.columns:
        changes = changes.withColumn(DELETED, F.lit(False))
    changes = changes.withColumn(DELETED, F.coalesce(DELETED, F.lit(False)))
    compared = list(tracked) if tracked else [c for c in columns if c not in keys and c not in sequence]
    compared.append(DELETED)

    # Several rows of one key at one sequence value are one change. Copies are dropped
    # before the shuffle, so a large group of copies costs no more than others.
    chunks = in_chunks(changes, keys, sequence, pieces)
    cut = [c for c in chunks.columns if c not in changes.columns and c != CHUNK]
    single = latest_per_key(chunks, [*keys, CHUNK, *cut, *sequence], DELETED)
    seen = neighbours(single, keys, sequence, previous=compared)
    same = F.col("__prev").isNotNull()
    for c in compared:
        same = same & F.col(f"__prev.`{c}`").eqNullSafe(F.col(f"`{c}`"))
    changed = seen.where(~same).drop("__prev")
    out = neighbours(changed, keys, sequence, following=[sequence[0]])
    return out.where(~F.col(DELETED)).select(
        *columns,
        F.col(f"`{sequence[0]}`").alias(START),
        F.col(f"__next.`{sequence[0]}`").alias(END),
    )


def refresh_history(
    history: DataFrame,
    log: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] | str,
    sequence_by: Sequence[str] | str,
    **options,
) -> DataFrame:
    """History after a new batch: only the keys in the batch are computed again.

    `log` is the full change log including the batch.
    """
    keys = _names(keys)
    touched = batch.select(*[F.col(f"`{k}`").alias(f"__t_{k}") for k in keys]).distinct()
    of_touched = log.join(touched, null_safe(log, touched, keys, "__t_"), "left_semi")
    untouched = history.join(touched, null_safe(history, touched, keys, "__t_"), "left_anti")
    again = apply_changes(of_touched, keys, sequence_by, scd_type=2, **options)
    return untouched.unionByName(again)
