"""A uniform shuffle into shards whose numbers of rows differ by one at most, by a communication matrix.

Rows lie in cells by a hash of their own values, so that a lost task finds the same rows again. The number of rows that
each cell sends to each shard is drawn first, from the multivariate hypergeometric law that a uniform permutation of all
rows would follow; then each cell deals its rows out in random order, and each shard orders what it has received at random.
Only the counts of the cells, one number for each million rows, reach the driver.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.helpers import cut, text_of

SHARDS = 8
CELLS = 64
ROWS_PER_CELL = 1_000_000
ROWS_PER_PART = 100_000


def hypergeometric(good: int, bad: int, draws: int, rng: random.Random) -> int:
    """How many of `draws` without replacement are good; found from the most likely number outwards, for any size."""
    total = good + bad
    least, most = max(0, draws - bad), min(draws, good)
    if least == most:
        return least

    def chance(k: int) -> float:
        log = math.lgamma
        return math.exp(
            log(good + 1) - log(k + 1) - log(good - k + 1) + log(bad + 1) - log(draws - k + 1)
            - log(bad - draws + k + 1) - log(total + 1) + log(draws + 1) + log(total - draws + 1)
        )

    middle = min(most, max(least, (draws + 1) * (good + 1) // (total + 2)))
    u = rng.random()
    low = high = middle
    p_low = p_high = chance(middle)
    u -= p_low
    if u <= 0:
        return middle
    while True:
        if high < most:
            p_high *= (good - high) * (draws - high) / ((high + 1) * (bad - draws + high + 1))
            high += 1
            u -= p_high
            if u <= 0:
                return high
        if low > least:
            p_low *= low * (bad - draws + low) / ((good - low + 1) * (draws - low + 1))
            low -= 1
            u -= p_low
            if u <= 0:
                return low
        if (high == most and low == least) or (p_high < 1e-300 and p_low < 1e-300):
            return middle  # what rounding has left of the chances


def communication_matrix(cells: list[int], shards: int, rng: random.Random) -> list[list[int]]:
    """Rows that each cell sends to each shard; the sums of its columns differ by one at most."""
    total = sum(cells)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = []
    for count in cells:
        row, left, open_room = [], count, sum(room)
        for s in range(shards):
            x = left if s == shards - 1 else hypergeometric(room[s], open_room - room[s], left, rng)
            open_room -= room[s]
            left -= x
            row.append(x)
        room = [r - x for r, x in zip(room, row, strict=True)]
        matrix.append(row)
    return matrix


def shuffle_into_shards(docs: DataFrame, shards: int = SHARDS, seed: int = 20) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): every row of `docs` in one shard, slots without gaps from 0.

    size is the UTF-8 length of the text plus 1; a null text counts as empty. Equal texts are spread like any others. Rows
    that are equal in id and text may change places; a null id is a value like others. An empty table gives
    no row. The same seed gives the same shards.
    """
    spark = docs.sparkSession
    text, values = text_of(), ("doc_id", "size", "text_crc32")
    hashed = lambda k: F.xxhash64(F.lit(seed * 16 + k), *values)
    rows = cut(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        ).select("*", hashed(0).alias("deal"), hashed(1).alias("place"))
    )
    total = rows.count()
    cells = max(CELLS, math.ceil(total / ROWS_PER_CELL))
    rows = rows.withColumn("cell", F.pmod(hashed(2), F.lit(cells)))
    found = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}  # `cells` rows at most
    matrix = communication_matrix([found.get(c, 0) for c in range(cells)], shards, random.Random(seed))
    ends = [{"cell": c, "ends": [sum(row[: s + 1]) for s in range(shards)]} for c, row in enumerate(matrix)]
    sent = spark.range(1).select(
        F.inline(F.from_json(F.lit(json.dumps(ends)), "array<struct<cell:bigint,ends:array<bigint>>>"))
    )
    order = Window.partitionBy("cell").orderBy("deal", *values)
    nth = F.row_number().over(order)
    dealt = rows.withColumn("nth", nth).join(sent, "cell").select(
        *values, "place", F.size(F.filter("ends", lambda e: e < F.col("nth"))).alias("shard")
    )
    parts = max(16, math.ceil(total / shards / ROWS_PER_PART))
    dealt = cut(dealt.withColumn("part", F.pmod(F.col("place"), F.lit(parts))))
    sizes = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "part").orderBy("place", *values)
    return dealt.withColumn("nth", F.row_number().over(within)).join(starts, ["shard", "part"]).select(
        *values, "shard", (F.col("first") + F.col("nth") - 1).alias("slot")
    )
