"""Table-level shaping: scope columns, renames, nesting and unnesting, unions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import positions

_SHAPES: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register_shape(table: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """Transform hook for one table."""
    _SHAPES[table] = fn


def shape(df: DataFrame, table: str) -> DataFrame:
    """Apply the hook of a table; a table without one passes through."""
    return df.transform(_SHAPES.get(table, lambda d: d))


def with_scope(df: DataFrame, scope: Mapping[str, Column | str]) -> DataFrame:
    """Add scope columns: a literal text, or a column expression over the row."""
    return df.withColumns({n: v if isinstance(v, Column) else F.lit(v) for n, v in scope.items()})


def rename_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Written column names to the names they come back under."""
    return df.withColumnsRenamed(dict(mapping))


def union_tables(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by column name; a column one lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def explode_children(
    df: DataFrame,
    children: str,
    parent: Mapping[str, str],
    *,
    where: Callable[[Column], Column] | None = None,
    child: str = "child",
) -> DataFrame:
    """One row per child of a nested array, with parent columns carried under new names.

    `where` is a test on the child and runs inside the array, before rows are made.
    Works on streams.
    """
    items = F.col(children)
    if where is not None:
        items = F.filter(items, where)
    carried = [F.col(path).alias(name) for name, path in parent.items()]
    return df.select(*carried, F.explode(items).alias(child))


def nest_children(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    *,
    name: str = "children",
    max_children: int | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Child rows back to one array per parent, in order.

    One row per parent with `part` 0. With `max_children`, a parent with more gets further
    rows with `part` 1, 2, ..: no child is dropped, and no task holds more than one
    part, however large the parent.
    """
    if max_children is None:
        numbered, part = df.withColumn("__at", F.struct(*order)), F.lit(0).cast("bigint")
    else:
        numbered = positions(df, keys, order, "__at", pieces)
        part = F.floor((F.col("__at") - 1) / F.lit(max_children)).cast("bigint")
    child = F.struct(F.col("__at"), *[F.col(c) for c in columns])
    nested = numbered.groupBy(*keys, part.alias("part")).agg(
        F.array_sort(F.collect_list(child)).alias("__items")
    )
    plain = F.transform("__items", lambda x: F.struct(*[x[c].alias(c) for c in columns]))
    return nested.select(*keys, "part", plain.alias(name))
