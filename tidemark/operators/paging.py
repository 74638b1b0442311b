"""Landed response pages: unnesting, page numbers, and the end of a run of pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.conform import member
from tidemark.operators.ordered import positions

# Rows per page and pages per batch of the paged services.
PAGE_SIZE = 100
MAX_PAGES_PER_BATCH = 50


def unnest_envelope(
    pages: DataFrame, body: str, key: str | None, *, keep: Sequence[str] = (), name: str = "payload"
) -> DataFrame:
    """One row per record of a response body, as JSON text.

    `key` names the array inside the envelope; None when the body is the array. A
    missing array gives no rows.
    """
    envelope = F.try_parse_json(F.col(body))
    for step in key.split(".") if key else ():
        envelope = member(envelope, step)
    items = F.try_variant_get(envelope, "$", "array<variant>")
    return pages.select(*keep, F.explode(items).alias("__item")).select(
        *keep, F.to_json("__item").alias(name)
    )


def bounded_batch(df: DataFrame, order: Sequence[str], rows: int, *, after: dict | None = None) -> DataFrame:
    """The next `rows` rows in order, as the option asks for (a top-k, not a full sort).

    `after` maps the order columns to the last row taken, so a capped batch moves on
    even if many rows share one cursor value.
    """
    if after:
        last = F.struct(*[F.lit(after[c]).cast(df.schema[c].dataType).alias(c) for c in order])
        # The first column alone is a weaker bound, but one that reaches the file scan.
        first = F.lit(after[order[0]]).cast(df.schema[order[0]].dataType)
        df = df.where((F.col(order[0]) >= first) & (F.struct(*order) > last))
    return df.orderBy(*order).limit(rows)


def batch_ends(df: DataFrame, order: Sequence[str], position: str, rows: int, *, after: int, last: int) -> DataFrame:
    """The ends of all batches of `rows` rows behind position `after`, in one pass, where `bounded_batch` gives the next one alone.

    `position` numbers the rows in their order, without gaps up to `last`. Gives for each batch the position `upto` and the place `end` of its last
    row, and whether the next row has the same place (`parted`).
    """
    place = F.struct(*[F.col(f"`{c}`") for c in order])
    behind = F.col(position) - after - 1
    edges = df.where((behind % rows == 0) | (behind % rows == rows - 1) | (F.col(position) == last))
    edges = edges.select(F.col(position).alias("__at"), place.alias("__place"), F.floor(behind / F.lit(rows)).alias("__batch"))
    ends = edges.groupBy("__batch").agg(F.min("__place").alias("__first"), F.max("__place").alias("end"), F.max("__at").alias("upto"))
    following = F.lead("__first").over(Window.orderBy("__batch"))
    return ends.select("upto", "end", F.coalesce(following == F.col("end"), F.lit(False)).alias("parted"))


def batch_rows(per_page=None, max_pages=None) -> int:
    """Row cap from text options: page size kept in 1..100, unreadable text takes the default."""

    def number(text, default: int) -> int:
        try:
            return int(text)
        except (TypeError, ValueError):
            return default

    size = max(1, min(number(per_page, PAGE_SIZE), PAGE_SIZE))
    return size * max(0, number(max_pages, MAX_PAGES_PER_BATCH))


def keyset_page(df: DataFrame, key: str, after=None, size: int = PAGE_SIZE) -> DataFrame:
    """The page that starts after a key."""
    if after is not None:
        df = df.where(F.col(key) > F.lit(after).cast(df.schema[key].dataType))
    return df.orderBy(key).limit(size)


def assign_pages(
    df: DataFrame,
    key: Sequence[str] | str,
    size: int = PAGE_SIZE,
    *,
    by: Sequence[str] = (),
    first: int = 1,
    pieces: int | None = None,
) -> DataFrame:
    """Page number of every row in key order, for all pages at once."""
    order = [key] if isinstance(key, str) else list(key)
    numbered = positions(df, list(by), order, "__at", pieces)
    page = F.floor((F.col("__at") - 1) / F.lit(size)).cast("bigint") + first
    return numbered.withColumn("page", page).drop("__at")


def page_range(
    pages: DataFrame, page: str, start: int = 1, *, rows: str | None = None, last: int | None = None
) -> DataFrame:
    """Pages from the offset page on, without empty ones; up to page `last` if the caller sets one."""
    kept = pages.where(F.col(page) >= start)
    if last is not None:
        kept = kept.where(F.col(page) <= last)
    return kept if rows is None else kept.where(F.coalesce(F.size(rows), F.lit(0)) > 0)


def page_chain(
    pages: DataFrame, run: Sequence[str], page: str, *, next_page: str, end_of_stream: str
) -> DataFrame:
    """Pages of each run up to the first one that ends it.

    A page ends its run if it says so, says nothing, or names no next page. The first
    end is an aggregate (combined before the shuffle), not a window over the run.
    """
    ends = F.coalesce(F.col(end_of_stream), F.lit(True)) | F.coalesce(F.col(next_page) == "", F.lit(True))
    first_end = (
        pages.where(ends)
        .groupBy(*[F.col(r).alias(f"__run_{r}") for r in run])
        .agg(F.min(page).alias("__end"))
    )
    condition = F.lit(True)
    for r in run:
        condition = condition & pages[r].eqNullSafe(F.col(f"__run_{r}"))
    joined = pages.join(first_end, condition, "left")
    return joined.where(F.col("__end").isNull() | (F.col(page) <= F.col("__end"))).select(*pages.columns)
