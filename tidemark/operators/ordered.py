"""Ordered work inside groups (lag, lead, row number) with one plan for groups of any size.

A plain window puts a whole group into one task. Here the rows of all groups are cut into `pieces` chunks along
(keys, order), like a range partitioning: a chunk holds many small groups or a part of a large one. The window runs per
group and chunk. Only groups that a cut point falls into go over several chunks; for each further chunk of such a group one
row with the edge of the chunks before it is added, and is the first (or last) row that its window sees. There are fewer
such rows than chunks.

The cut points come from the rows with the smallest hashes, SAMPLED for each chunk, and are literals of the plan; so their
number does not grow with the data, and two readings of the rows cut them alike. They decide where chunks end and
nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

SAMPLED = 20
CHUNK = "__chunk"
_HASH = "__cut"
_EDGE = "__edge"
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """Join condition on `keys`, where the right side has them as `<prefix><key>`."""
    return reduce(
        lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(right[f"`{prefix}{k}`"]) for k in keys]
    )


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def in_chunks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: int | None = None
) -> DataFrame:
    """`df` with `__chunk`, and `__cut`: whether the row's group may lie in several chunks.

    Rows that are equal in keys and order are in one chunk. `pieces` is the number of chunks, by default that of the
    session's shuffle partitions.
    """
    session = df.sparkSession
    pieces = pieces or int(session.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(_columns([*keys, *order]))])
    kind = df.select(place.alias("p")).schema["p"].dataType
    parsed = F.from_json(F.to_json("p", _JSON), kind, _JSON)
    own_keys = [F.col(f"q.c{i}") for i in range(len(keys))]
    sampled = (
        df.select(place.alias("p"), F.xxhash64(*_columns([*keys, *order])).alias("h"))
        .orderBy("h")
        .limit(SAMPLED * pieces)
        .select(parsed.alias("q"))
        .orderBy("q")
        .select(F.to_json("q", _JSON).alias("cut"), (F.xxhash64(*own_keys) if keys else F.lit(0)).alias("key"))
        .collect()
    )
    step = max(1, len(sampled) // pieces)
    chosen = sampled[step::step]
    if not chosen:
        return df.withColumns({CHUNK: F.lit(0), _HASH: F.lit(False)})
    cuts = F.from_json(F.lit("[" + ",".join(r["cut"] for r in chosen) + "]"), ArrayType(kind), _JSON)
    steps = [1 << b for b in range(len(chosen).bit_length() - 1, -1, -1)]
    chunk = F.aggregate(  # binary search: how many cut points are not after the row
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda low, s: F.when((low + s <= len(chosen)) & (F.get(cuts, low + s - 1) <= place), low + s).otherwise(low),
    )
    key = F.xxhash64(*_columns(keys)) if keys else F.lit(0).cast("bigint")
    return df.withColumns({CHUNK: chunk, _HASH: key.isin([int(r["key"]) for r in chosen])})


def _with_edges(part: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows of `edges`, with `__edge` -1 or 1, beside those of `part`, with 0."""
    return part.withColumn(_EDGE, F.lit(0)).unionByName(edges, allowMissingColumns=True)


def neighbours(
    part: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    previous: Sequence[str] = (),
    following: Sequence[str] = (),
) -> DataFrame:
    """Add `__prev` / `__next`: a struct of the named columns of the neighbour row in the group.

    Takes the rows of `in_chunks` and keeps its columns, so that a second call needs no other shuffle. Filters may run
    between, and rows must be unique in keys and order.
    """
    place = F.struct(*_columns(order))
    chunks = Window.partitionBy(*_columns(keys)).orderBy(CHUNK)
    cut = part.where(_HASH)
    out = part
    for name, columns, edge in (("__prev", previous, -1), ("__next", following, 1)):
        if not columns:
            continue
        values = F.struct(*_columns(columns))
        last = (F.max_by if edge < 0 else F.min_by)(values, place).alias("__value")
        moved = (F.lag if edge < 0 else F.lead)("__value").over(chunks).alias("__value")
        edges = cut.groupBy(*_columns(keys), CHUNK).agg(last).select(*_columns(keys), CHUNK, moved)
        edges = edges.where("__value is not null").withColumn(_EDGE, F.lit(edge))
        marked = _with_edges(out.withColumn("__value", values), edges)
        window = Window.partitionBy(*_columns(keys), CHUNK).orderBy(_EDGE, *_columns(order))
        beside = (F.lag if edge < 0 else F.lead)("__value").over(window)
        out = marked.withColumn(name, beside).where(F.col(_EDGE) == 0).drop("__value", _EDGE)
    return out


def positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    pieces: int | None = None,
) -> DataFrame:
    """Add the 1-based row number in its group (in the whole table for no keys).

    Rows that are equal in `order` are numbered by a hash of their other columns.
    """
    columns = df.columns
    tie = F.xxhash64(*[F.to_json(F.struct(c)) if df.schema[n].dataType.simpleString().startswith(("map", "variant")) else c
                       for n, c in zip(columns, _columns(columns), strict=True)])
    rows = in_chunks(df.withColumn("__tie", tie), keys, [*order, "__tie"], pieces)
    before = Window.partitionBy(*_columns(keys)).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.where(_HASH).groupBy(*_columns(keys), CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    edges = counted.select(*_columns(keys), CHUNK, F.sum("__n").over(before).alias("__before"))
    edges = edges.where("__before is not null").withColumn(_EDGE, F.lit(-1))
    marked = _with_edges(rows.withColumn("__before", F.lit(None).cast("bigint")), edges)
    window = Window.partitionBy(*_columns(keys), CHUNK).orderBy(_EDGE, *_columns(order), "__tie")
    earlier = F.first("__before").over(window)  # of the edge row, if there is one
    number = F.row_number().over(window) + F.when(earlier.isNull(), 0).otherwise(earlier - 1)
    numbered = marked.withColumn(name, number.cast("bigint"))
    return numbered.where(F.col(_EDGE) == 0).select(*_columns(columns), name)
