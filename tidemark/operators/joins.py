"""Parent/child, detail and association joins, and set checks.

No side is broadcast by hint here: sizes are not known, so the choice is left to
Spark's size check and to adaptive execution, which also splits skewed children.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.shaping import fail_on


def expand_children(
    parents: DataFrame,
    children: DataFrame,
    on: Mapping[str, str],
    *,
    carry: Mapping[str, str],
    only: Column | None = None,
) -> DataFrame:
    """Children with columns of their parent.

    on     parent column -> child column.
    carry  output name -> parent column. Only these parent columns are read.
    only   test on the parents, for one parent or a state.
    """
    if only is not None:
        parents = parents.where(only)
    slim = parents.select(
        *[F.col(p).alias(f"__p_{p}") for p in on], *[F.col(p).alias(n) for n, p in carry.items()]
    )
    condition = F.lit(True)
    for parent_column, child_column in on.items():
        condition = condition & (F.col(f"__p_{parent_column}") == children[child_column])
    return children.join(slim, condition).drop(*[f"__p_{p}" for p in on])


def expand_detail(
    items: DataFrame,
    details: DataFrame,
    on: Mapping[str, str],
    *,
    carry: Mapping[str, str],
    missing: str = "fail",
) -> DataFrame:
    """List rows with the columns of their detail row.

    List rows without a complete reference are left out. A reference without a detail
    row fails the job, or with `missing="keep"` gives NULLs and `detail_found = false`.
    """
    usable = F.lit(True)
    for reference in on:
        usable = usable & F.col(reference).isNotNull()
    items = items.where(usable)
    slim = details.select(
        *[F.col(d).alias(f"__d_{d}") for d in on.values()],
        *[F.col(d).alias(n) for n, d in carry.items()],
        F.lit(True).alias("detail_found"),
    )
    condition = F.lit(True)
    for reference, detail_column in on.items():
        condition = condition & (items[reference] == F.col(f"__d_{detail_column}"))
    joined = items.join(slim, condition, "left").drop(*[f"__d_{d}" for d in on.values()])
    if missing == "keep":
        return joined.withColumn("detail_found", F.coalesce("detail_found", F.lit(False)))
    asked = F.concat_ws("/", *[F.col(r).cast("string") for r in on])
    problem = F.when(F.col("detail_found").isNull(), F.concat(F.lit("no detail for "), asked))
    return fail_on(joined, problem).drop("detail_found")


def association_edges(df: DataFrame, key: str, ids: str, *, names: tuple[str, str]) -> DataFrame:
    """One row per (object, associated id) of an id-array column."""
    return df.select(F.col(key).alias(names[0]), F.explode(ids).alias(names[1]))


def missing_rows(written: DataFrame, returned: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Written rows that do not come back, compared null-safe on the mapped columns."""
    back = returned.select(*[F.col(r).alias(f"__r_{r}") for r in mapping.values()])
    condition = F.lit(True)
    for w, r in mapping.items():
        condition = condition & written[w].eqNullSafe(F.col(f"__r_{r}"))
    return written.join(back, condition, "left_anti")


def rows_present(written: DataFrame, returned: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """One row: how many written rows are missing, and whether the check passed."""
    return missing_rows(written, returned, mapping).agg(
        F.count(F.lit(1)).alias("missing_rows"), (F.count(F.lit(1)) == 0).alias("passed")
    )


def not_in(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of `left` that `right` lacks; empty means left is a subset."""
    return left.select(*columns).subtract(right.select(*columns))
