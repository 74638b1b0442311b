"""Row filters used by the scans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def state_filter(df: DataFrame, column: str, state: str | None = "all") -> DataFrame:
    """Rows in one state; `all` or nothing keeps every row."""
    return df if state in (None, "", "all") else df.where(F.col(column) == state)


def exclude_archived(df: DataFrame, flag: str = "archived") -> DataFrame:
    """Rows not archived; a missing flag counts as not archived."""
    return df.where(~F.coalesce(F.col(flag), F.lit(False)))


def split_rejects(df: DataFrame, well_formed: Column | str) -> tuple[DataFrame, DataFrame]:
    """Usable rows and malformed ones. An unknown (NULL) test is malformed."""
    good = F.coalesce(F.expr(well_formed) if isinstance(well_formed, str) else well_formed, F.lit(False))
    return df.where(good), df.where(~good)


def scan_scope(df: DataFrame, scope: Mapping[str, str], *, required=(), exactly_one_of=()) -> DataFrame:
    """Rows of one scope (owner and repository, or an organisation).

    The scope names are columns, best the partition columns of the landed table, so the
    filter prunes whole directories. `required` and `exactly_one_of` are option checks.
    """
    given = {k: v for k, v in scope.items() if v not in (None, "")}
    missing = [k for k in required if k not in given]
    if missing:
        raise ValueError(f"scope needs non-empty {', '.join(missing)}")
    if exactly_one_of and sum(k in given for k in exactly_one_of) != 1:
        raise ValueError(f"scope needs exactly one of {', '.join(exactly_one_of)}")
    for column, value in given.items():
        df = df.where(F.col(column) == value)
    return df
