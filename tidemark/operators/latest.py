"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def total_order(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> list[str]:
    """The sequence columns, then every other comparable column as the tie-break.

    Two rows that are equal in all of these are the same row, so the choice
    between them cannot be seen and the result does not depend on arrival order.
    """
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in keys and f.name not in sequence and orderable(f.dataType)
    ]
    return [*sequence, *rest]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] | str,
    sequence_by: Sequence[str] | str,
    *,
    ranked: bool = True,
) -> DataFrame:
    """One row per key: the one with the highest sequence.

    Both forms reduce each key to one row per input partition before the shuffle,
    so a hot key moves as few rows as any other. `ranked` sorts rows once and keeps
    the first (a window with a group limit); the other form is a `max_by`
    aggregate, which suits narrow rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    sequence = [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)
    if not keys or not sequence:
        raise ValueError("latest_per_key needs at least one key and one sequence column")
    order = total_order(df, keys, sequence)
    if ranked:
        # A missing sequence is older than any value.
        newest: list[Column] = [F.desc_nulls_last(f"`{c}`") for c in order]
        w = Window.partitionBy(*keys).orderBy(*newest)
        return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")
    rest = [c for c in df.columns if c not in keys]
    newest_row = F.max_by(
        F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[F.col(f"`{c}`") for c in order])
    )
    packed = df.groupBy(*keys).agg(newest_row.alias("__row"))
    return packed.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__row.`{c}`") for c in df.columns])
