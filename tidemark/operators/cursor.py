"""Cursor bookkeeping: bounds, high-water marks, lookback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.convert import iso_minus_seconds

# Fixed value: seconds of a cursor window that are read again for late data.
LOOKBACK_SECONDS = 300


def scan_since(df: DataFrame, cursor: str, high_water_mark=None, start=None) -> DataFrame:
    """Rows at or after the bound; the whole table when there is none.

    The stored mark wins over the configured start. The cursor is compared as a
    plain column with a literal, so the bound reaches the file scan. A bound that isn't of the
    cursor's type (a text that is no time, say) reads from the start.
    """
    bound = start if high_water_mark is None or high_water_mark == "" else high_water_mark
    if bound is None or bound == "":
        return df
    literal = (bound if isinstance(bound, Column) else F.lit(bound)).try_cast(df.schema[cursor].dataType)
    return df.where(literal.isNull() | (F.col(cursor) >= literal))  # the first part is folded away


def read_between(df: DataFrame, cursor: str, start, end) -> DataFrame:
    """Rows in `(start, end]`: the same rows every time a range is read again."""
    low, high = _bound(df, cursor, start), _bound(df, cursor, end)
    return df.where((F.col(cursor) > low) & (F.col(cursor) <= high))


def _bound(df: DataFrame, cursor: str, value) -> Column:
    """Literal of the cursor's own type, so that the column is compared without a cast."""
    literal = value if isinstance(value, Column) else F.lit(value)
    return literal.cast(df.schema[cursor].dataType)


def high_water_mark(
    df: DataFrame, cursor: str, by: Sequence[str] = (), previous: Column | None = None
) -> DataFrame:
    """Highest cursor, NULLs skipped, never below `previous`."""
    top = F.max(cursor)
    if previous is not None:
        top = F.greatest(top, previous)
    return df.groupBy(*by).agg(top.alias("high_water_mark"))


def next_cursor(
    df: DataFrame,
    cursor: str,
    by: Sequence[str] = (),
    *,
    lookback_seconds: int = LOOKBACK_SECONDS,
    previous: Column | None = None,
) -> DataFrame:
    """Where the next read of an ISO-text cursor starts.

    The maximum moved back by the lookback; the raw maximum if it is not a time; the
    previous cursor if there were no rows.
    """
    top = F.max(cursor)
    moved = iso_minus_seconds(F.col("__top"), lookback_seconds)
    if previous is not None:
        moved = F.coalesce(moved, previous)
    return df.groupBy(*by).agg(top.alias("__top")).select(*by, moved.alias("next_cursor"))
