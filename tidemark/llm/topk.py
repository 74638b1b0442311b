"""Exact inner-product search over vectors in buckets of similar length.

Vectors are dealt into buckets by their length, longest first. The first bucket gives every query a score that its answer can't
fall below; with it, a later bucket is left out for a query if even a vector of the bucket's greatest length in the
query's direction would score less. For the others, that score over both lengths is a local cosine threshold, which chooses how
to prune: if it is high, by coordinates (a unit vector so close to the query must have its largest coordinates in narrow
ranges), else by length alone. What is left is scored by exact products of whole numbers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.helpers import cut, workers_find_package

SCALE = 1024
BUCKET_ROWS = 4096
QUERY_ROWS = 1024
#: Ranges of length at most; a range with more rows than a bucket holds is split into several buckets.
RANGES = 256
#: From this local cosine threshold on, coordinates prune better than length alone.
COORDINATE_FROM = 0.6
FOCUS = 6
_SLACK = 1e-9
_LONG = (1 << 63) - 1


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, scale: int = SCALE) -> DataFrame:
    """(id, vector, length): each component as floor(scale * x). Vectors that are null or empty, or hold a null or
    non-finite component, and rows without an id, take no part. A component beyond a long takes its nearest value."""
    x = F.transform(F.col(vector_column), lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        vectors.select(F.col(id_column).cast("long").alias("id"), x.alias("x"))
        .filter(F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & fine)
        .select("id", F.transform("x", lambda v: F.floor(F.least(F.greatest(v * scale, F.lit(-9.2e18)), F.lit(9.2e18))).cast("long")).alias("vector"))
        .withColumn("length", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def _products(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Exact inner products of whole vectors as longs; those beyond a long take its nearest value."""
    def peak(m):
        return max(abs(int(m.min())), abs(int(m.max()))) if m.size else 0

    bound = peak(one) * peak(two) * one.shape[1]
    if bound < 1 << 53:
        return (one.astype(np.float64) @ two.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return one @ two.T
    exact = one.astype(object) @ two.astype(object).T
    return np.vectorize(lambda v: max(-_LONG - 1, min(_LONG, v)), otypes=[np.int64])(exact)


def search_bucket(
    query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """(query, id, score) of up to k best of one bucket for each query that score `floors` or more.

    `vectors` are sorted by falling length.
    """
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    query_lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    units = vectors / np.maximum(lengths, 1e-300)[:, None]
    everything, found = None, []
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(query_lengths * lengths[0] > 0, floors / (query_lengths * lengths[0]), -np.inf)
    for i, threshold in enumerate(local):
        if threshold > 1 + _SLACK:
            continue
        if threshold >= COORDINATE_FROM:  # coordinate pruning
            unit = queries[i] / query_lengths[i]
            focus = np.argsort(-np.abs(unit))[:FOCUS]
            t = min(threshold, 1.0) - _SLACK
            spread = np.sqrt(np.maximum((1 - unit[focus] ** 2) * (1 - t * t), 0)) + 1e-7
            near = _feasible(units, unit, focus, t, spread)
            scores = _products(queries[i : i + 1], vectors[near])[0]
        else:  # length pruning
            if everything is None:
                everything = _products(queries, vectors)
            least = floors[i] / query_lengths[i] if query_lengths[i] > 0 and np.isfinite(floors[i]) else -np.inf
            count = int(np.searchsorted(-lengths, -(least - 1e-6 * abs(least)), side="right")) if np.isfinite(least) else len(lengths)
            near, scores = np.arange(count), everything[i, :count]
        keep = (scores >= floors[i]) & (ids[near] != query_ids[i])
        near, scores = near[keep], scores[keep]
        if len(near) > k:
            worst = np.partition(scores, len(scores) - k)[len(scores) - k]
            near, scores = near[scores >= worst], scores[scores >= worst]
            best = np.lexsort((ids[near], -scores))[:k]
            near, scores = near[best], scores[best]
        found += zip([int(query_ids[i])] * len(near), ids[near].tolist(), scores.tolist(), strict=True)
    return found


def _feasible(units: np.ndarray, unit: np.ndarray, focus: np.ndarray, t: float, spread: np.ndarray) -> np.ndarray:
    """Rows whose focus coordinates lie where a unit vector with a cosine of t or more to `unit` can have them."""
    q = unit[focus]
    low = np.where(q < -t, -1.0, q * t - spread)
    high = np.where(q > t, 1.0, q * t + spread)
    x = units[:, focus]
    return np.flatnonzero(((x >= low - 1e-7) & (x <= high + 1e-7)).all(axis=1))


def _search(blocks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Best scores of each query in each of the buckets that it is paired with (query rows hold the bucket)."""

    def work(key, left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        left = left.sort_by([("length", "descending"), ("id", "ascending")]).combine_chunks()
        right = right.combine_chunks()
        found = search_bucket(
            right.column("id").to_numpy(), _matrix(right.column("vector").combine_chunks()),
            right.column("floor").to_numpy(), left.column("id").to_numpy(),
            _matrix(left.column("vector").combine_chunks()), k,
        )
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    keys = ("size", "bucket", "block")
    workers_find_package(blocks.sparkSession)
    blocks, queries = (f.select(*(F.col(c).alias(c) for c in f.columns)) for f in (blocks, queries))  # columns of their own
    return blocks.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(
        work, "query_id long, vec_id long, score long"
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_products(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding",
    scale: int = SCALE, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of `vectors` with the highest whole inner products, for each of `queries`.

    Both tables have an id and a vector; a query's own id is no candidate, ties go to the smaller id, and a query with fewer
    candidates gets them all. Vectors of different dimension are never compared. Rows that repeat an id and vector count
    once; of a repeated query id, the smallest vector is asked. Buckets hold `bucket_rows` vectors and meet blocks of QUERY_ROWS queries, so that no task holds more.
    """
    rows = cut(whole_vectors(vectors, id_column, vector_column, scale).distinct().withColumn("size", F.size("vector")))
    asked = (
        whole_vectors(queries, id_column, vector_column, scale).groupBy("id")
        .agg(F.min(F.struct("vector", "length")).alias("v")).select("id", "v.*").withColumn("size", F.size("vector"))
    )
    total, wanted = rows.count(), asked.count()
    if not total or not wanted:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    parts = min(RANGES, max(1, math.ceil(total / bucket_rows)))
    cuts = rows.select(F.percentile_approx("length", [i / parts for i in range(1, parts)] or [0.5], 10 * parts)).first()[0]
    longer = F.lit(0)
    if parts > 1:
        steps = F.array(*[F.lit(float(c)) for c in cuts])
        longer = F.size(F.filter(steps, lambda c: c > F.col("length")))
    ranged = rows.withColumn("range", longer)
    counts = {(r["size"], r["range"]): r["count"] for r in ranged.groupBy("size", "range").count().collect()}
    split = F.from_json(
        F.lit("[" + ",".join(f'{{"size":{s},"range":{g},"split":{math.ceil(n / bucket_rows)}}}' for (s, g), n in counts.items()) + "]"),
        "array<struct<size:int,range:int,split:int>>",
    )
    splits = rows.sparkSession.range(1).select(F.inline(split))
    dealt = cut(
        ranged.join(F.broadcast(splits), ["size", "range"])
        .withColumn("bucket", F.pmod(F.xxhash64("id"), F.col("split")) * RANGES + F.col("range"))
        .select("size", "bucket", "id", "vector", "length")
    )
    blocks = max(1, math.ceil(wanted / QUERY_ROWS))
    asked = cut(asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")))
    buckets = cut(dealt.groupBy("size", "bucket").agg(F.max("length").alias("longest")))
    first = buckets.groupBy("size").agg(F.max_by("bucket", F.struct("longest", "bucket")).alias("bucket"))

    def block_rows(of: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        return of.select("size", "bucket", "id", "vector", "length", every)

    opening = asked.join(F.broadcast(first), "size").withColumn("floor", F.lit(float("-inf")))
    found = cut(_search(block_rows(dealt.join(F.broadcast(first), ["size", "bucket"], "left_semi")), opening, k))
    floors = _best(found, k).groupBy("query_id").agg(F.min("score").alias("low"), F.count("*").alias("n"))
    floors = floors.select(
        F.col("query_id").alias("id"), F.when(F.col("n") == k, F.col("low") - F.abs("low") * 1e-12).cast("double").alias("low")
    )
    rest = buckets.join(F.broadcast(first), ["size", "bucket"], "left_anti")
    later = (
        asked.join(floors, "id", "left").withColumn("floor", F.coalesce("low", F.lit(float("-inf")))).drop("low")
        .join(rest, "size").filter(F.col("length") * F.col("longest") * (1 + 1e-9) >= F.col("floor")).drop("longest")
    )
    return _best(found.union(_search(block_rows(dealt.join(F.broadcast(first), ["size", "bucket"], "left_anti")), later, k)), k).select(
        "query_id", "rank", "vec_id", "score"
    )
