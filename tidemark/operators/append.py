"""Append flow helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import null_safe


def dedupe_append(
    rows: DataFrame,
    keys: Sequence[str] | str,
    *,
    stored: DataFrame | None = None,
    event_time: str | None = None,
    delay: str = "300 seconds",
    salts: int = 8,
) -> DataFrame:
    """Rows to append, each key once.

    Batch: repeats inside `rows` and keys already in `stored` are left out. On a
    stream the repeats are dropped inside the watermark of `event_time`, which
    bounds the state but also drops rows that come later than `delay`; without an
    event time the state keeps every key and nothing else is dropped.

    salts  a stream cannot combine before its shuffle, so a key with very many copies is
           first reduced in `salts` places. 1 saves that step where copies are rare.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if rows.isStreaming:
        if event_time is not None:
            rows = rows.withWatermark(event_time, delay)

        def once(df: DataFrame, by: list[str]) -> DataFrame:
            return df.dropDuplicates(by) if event_time is None else df.dropDuplicatesWithinWatermark(by)

        if salts > 1:
            salted = rows.withColumn("__salt", F.floor(F.rand(7) * salts))
            rows = once(salted, [*keys, "__salt"]).drop("__salt")
        return once(rows, keys)
    fresh = rows.dropDuplicates(keys)
    if stored is None:
        return fresh
    known = stored.select(*[F.col(f"`{k}`").alias(f"__k_{k}") for k in keys])
    return fresh.join(known, null_safe(fresh, known, keys, "__k_"), "left_anti")
