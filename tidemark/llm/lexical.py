"""Ranked lexical search: posting lists in blocks of documents, read by a hybrid of term-at-a-time and document-at-a-time.

`build_index` cuts the documents into blocks and keeps for each term of a block the documents that hold it, and for each
block the ids and lengths of its documents. Nothing is shuffled for it, and a term's list is spread over as many rows as there are
blocks. `search` brings the lists of the queries' terms together by block. In a block, and for one query,

* the short lists are summed term by term into accumulators, sorted by document;
* the accumulators are then one more list, bounded by their largest sum, beside the long lists, each with its own bound;
* documents are taken in order from the lists whose bounds can lift a document into the result. The other lists are only looked into
  (by binary search) for documents whose sum so far and whose outstanding bounds still reach the result's last score.

The result so far of a query is kept from block to block of a task, so that later blocks, ranges and lists are skipped as a whole when
their bounds stay below its last score. The best of all tasks are merged at the end.

Terms are the maximal runs of ASCII letters, digits and all characters beyond ASCII, with A-Z lower-cased. A null or empty text has no
terms: as a document it is never found, as a query it finds nothing. Documents of one id are ranked each by itself; null ids come
last among equal scores. Repeated query ids are one query for each row, told apart by their place. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.helpers import arrow_map, cut, shared_folder, workers_find_package
from tidemark.llm.words import text_buffers

#: Documents of a block, and bytes of their texts; a longer text is a block by itself.
BLOCK_ROWS = 4096
BLOCK_BYTES = 1 << 22
#: Documents of a block that a task looks at together, at most.
RANGE = 1024
#: Lists that hold less than this share of a block's documents are short, and summed term by term.
SHORT = 1 / 16
#: Bytes of terms of the queries that are searched together.
TOGETHER = 1 << 20
#: Bytes of query terms that are broadcast; more of them are joined by keys.
BROADCAST = 1 << 23
#: Queries whose results a task keeps from block to block; then it hands them on and begins anew.
KEPT = 20_000
#: Blocks that a task searches, about.
BLOCKS_PER_TASK = 8

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_NO_ID = np.iinfo(np.int64).max


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LOWER).split()


class _Numbers(dict):
    def __missing__(self, term):
        self[term] = number = len(self)
        return number


_INDEX = "block long, term string, n_docs int, docs array<int>, tfs array<int>, ids array<long>, sizes array<int>"


def _block_rows(block: int, ids: pa.Array, words: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
    """The rows of one block: its documents in a row without a term, and a row for each term."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    numbers = _Numbers()
    codes = np.concatenate([np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words])
    held, tfs = np.unique(codes * len(words) + np.repeat(np.arange(len(words)), sizes), return_counts=True)
    ends = np.searchsorted(held, np.arange(len(numbers) + 1) * len(words))
    n = len(numbers)
    lists = lambda values, at, kind: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))
    nothing = pa.array([[]], pa.list_(pa.int32()))
    names = ["block", "term", "n_docs", "docs", "tfs", "ids", "sizes"]
    yield pa.RecordBatch.from_arrays(
        [pa.array([block]), pa.array([None], pa.string()), pa.array([len(words)], pa.int32()), nothing, nothing,
         lists(ids, [0, len(words)], pa.int64()), lists(sizes, [0, len(words)], pa.int32())], names,
    )
    for a in range(0, n, 1 << 14):
        b = min(n, a + (1 << 14))
        at = ends[a : b + 1] - ends[a]
        docs = (held[ends[a] : ends[b]] % len(words)).astype(np.int32)
        terms = pa.array([t.decode() for t in list(numbers)[a:b]] if a or b < n else [t.decode() for t in numbers], pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(b - a, block)), terms, pa.array(np.diff(at), pa.int32()), lists(docs, at, pa.int32()),
             lists(tfs[ends[a] : ends[b]], at, pa.int32()), pa.nulls(b - a, pa.list_(pa.int64())), pa.nulls(b - a, pa.list_(pa.int32()))],
            names,
        )


def build_index(docs: DataFrame, folder: str) -> DataFrame:
    """The index of all documents (doc_id, text), written to `folder` as Parquet and read from there."""
    workers_find_package(docs.sparkSession)

    def run(batches):
        first, count = TaskContext.get().partitionId() << 32, 0
        ids, words, held = [], [], 0

        def block():
            nonlocal ids, words, held, count
            yield from _block_rows(first + count, pa.array(ids, pa.int64()), words)
            ids, words, held, count = [], [], 0, count + 1

        for batch in batches:
            data, at = text_buffers(batch.column("text"))
            data = data.tobytes()
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                size = int(at[i + 1] - at[i])
                if words and (len(words) == BLOCK_ROWS or held + size > BLOCK_BYTES):
                    yield from block()
                ids.append(doc)
                words.append(data[at[i] : at[i + 1]].translate(_LOWER).split())
                held += size
        if words:
            yield from block()

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    columns.mapInArrow(run, _INDEX).write.mode("overwrite").parquet(folder)
    return docs.sparkSession.read.schema(_INDEX).parquet(folder)


def query_terms(items: DataFrame, item_id: str = "item_id") -> DataFrame:
    """(query, item_id, term, times): the terms of each row of `items`, with repeats counted."""

    def work(batch: pa.RecordBatch):
        rows = []
        for query, item, text in zip(*(batch.column(c).to_pylist() for c in ("query", "item_id", "text")), strict=True):
            counts: dict[bytes, int] = {}
            for t in terms_of(text):
                counts[t] = counts.get(t, 0) + 1
            rows += [(query, item, t.decode(), n) for t, n in counts.items()]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32())
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["query", "item_id", "term", "times"])

    numbered = items.select(
        F.monotonically_increasing_id().alias("query"), F.col(item_id).cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    return cut(arrow_map(numbered, work, "query long, item_id long, term string, times int"))


class _Best:
    """The `k` highest scores of a query so far, equal ones by ascending id."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        """A document below this score can't come in."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores, ids, null = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids]), np.concatenate([self.null, null])
        best = np.lexsort((null, ids, -scores))[: self.k]
        self.scores, self.ids, self.null = scores[best], ids[best], null[best]


def search_block(lists: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, null: np.ndarray, best: _Best) -> None:
    """The documents of one block for one query: `lists` has (documents in order, weighted values) of each of its terms."""
    n = len(ids)
    short = [x for x in lists if len(x[0]) < SHORT * n]
    iterators = [x for x in lists if len(x[0]) >= SHORT * n]
    if short:  # term at a time: one list of summed accumulators
        summed = np.zeros(n, np.int64)
        for docs, values in short:
            summed[docs] += values
        docs = np.flatnonzero(summed)
        iterators.append((docs, summed[docs]))
    bounds = np.array([values.max(initial=0) for _, values in iterators], dtype=np.int64)
    order = np.argsort(bounds, kind="stable")
    iterators, bounds = [iterators[i] for i in order], bounds[order]
    reach = np.cumsum(bounds)  # what the lists up to here can give a document together
    if not len(reach) or reach[-1] < best.least():
        return
    # Document at a time, range by range, so that the result's last score rises on the way.
    starts = [np.searchsorted(docs, np.arange(0, n + RANGE, RANGE)) for docs, _ in iterators]
    for r in range(math.ceil(n / RANGE)):
        needed = int(np.searchsorted(reach, best.least(), side="left"))  # lists before this one can't lift a document by themselves
        if needed == len(iterators):
            return
        sums = np.zeros(RANGE, np.int64)
        for (docs, values), at in zip(iterators[needed:], starts[needed:], strict=True):
            part = slice(at[r], at[r + 1])
            sums[docs[part] - r * RANGE] += values[part]
        found = np.flatnonzero(sums)
        sums = sums[found]
        found += r * RANGE
        for i in reversed(range(needed)):  # skip in the lists that are left, for documents that can still come in
            still = sums + reach[i] >= best.least()
            found, sums = found[still], sums[still]
            if not len(found):
                break
            docs, values = iterators[i]
            at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            sums = sums + np.where(docs[at] == found, values[at], 0)
        still = sums >= best.least()
        if still.any():
            best.add(sums[still], ids[found[still]], null[found[still]])


def search(index: DataFrame, terms: DataFrame, k: int = 20) -> DataFrame:
    """(query, item_id, rank, doc_id, score): the `k` documents with the highest scores above 0 for each query of `terms` (of `query_terms`).

    A term's weight is floor(1000 ln((2N+2) / (2df+1))), a document's length factor m is 75 + 25nN div L, and its score the sum of
    weight * (10^9 tf div (1000 tf + 12 m)) over the query's terms, repeats included.
    """
    blocks = index.where(F.col("term").isNull()).select("block", "ids", "sizes")
    held = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    full = F.size(F.filter("sizes", lambda x: x > 0))
    totals = blocks.agg(F.coalesce(F.sum(full), F.lit(0)).alias("n"), F.coalesce(F.sum(held), F.lit(0)).alias("l"), F.count("*").alias("blocks")).first()
    total_docs, total_terms = totals["n"], totals["l"]
    tasks = max(terms.sparkSession.sparkContext.defaultParallelism, math.ceil(totals["blocks"] / BLOCKS_PER_TASK))

    # Queries are dealt into parts of bounded size, and all queries of a part are searched together in a block.
    size = terms.agg(F.coalesce(F.sum(F.octet_length("term") + 24), F.lit(0))).first()[0]
    few = F.broadcast if size <= BROADCAST else lambda df: df
    part = F.pmod(F.xxhash64("query"), F.lit(math.ceil((size + 1) / TOGETHER)))
    asked = terms.withColumn("part", part)

    rows = index.where(F.col("term").isNotNull())
    frequency = rows.select("term", "n_docs").join(few(asked.select("term").distinct()), "term", "left_semi")
    frequency = frequency.groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * total_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    weighted = cut(asked.select("part", "term").distinct().join(frequency, "term").select("part", "term", weight.alias("weight")))
    hits = rows.select("block", "term", "docs", "tfs").join(few(weighted), "term")
    # One deal by block serves the lists of a block and the join with its documents.
    grouped = hits.repartition(tasks, "block").groupBy("part", "block").agg(F.collect_list(F.struct("term", "weight", "docs", "tfs")).alias("lists"))
    joined = grouped.join(blocks, "block")
    packed = asked.groupBy("part").agg(F.collect_list(F.struct("query", "item_id", "term", "times")).alias("asked"))
    if size <= BROADCAST:
        ready = joined.join(F.broadcast(packed), "part")
    else:  # each part once for every task that may need it, so that no key is hot
        salted = packed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
        ready = joined.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(tasks)).cast("int")).join(salted, ["part", "salt"])
    ready = ready.select("lists", "ids", "sizes", "asked")

    def run(batches):
        best: dict[int, tuple[int, _Best]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values for c in ("lists", "ids", "sizes", "asked")}
                _search_row(row, total_docs, total_terms, k, best)
                if len(best) > KEPT:
                    yield results(best)
                    best.clear()
        yield results(best)

    def results(best) -> pa.RecordBatch:
        out = [(q, item, int(i) if not z else None, int(s)) for q, (item, b) in best.items() for s, i, z in zip(b.scores, b.ids, b.null, strict=True)]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64())
        columns = zip(*out, strict=True) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query", "item_id", "doc_id", "score"])

    found = ready.mapInArrow(run, "query long, item_id long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _search_row(row: dict, total_docs: int, total_terms: int, k: int, best: dict) -> None:
    ids = row["ids"]
    null = np.asarray(ids.is_null())
    ids = ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False)
    factors = 75 + 25 * row["sizes"].to_numpy(zero_copy_only=False).astype(np.int64) * total_docs // max(total_terms, 1)
    terms, weights, docs, tfs = row["lists"].flatten()
    starts = docs.offsets.to_numpy() - docs.offsets[0].as_py()
    docs = docs.flatten().to_numpy(zero_copy_only=False)  # of this row alone
    tfs = tfs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    values = 1_000_000_000 * tfs // (1000 * tfs + 12 * factors[docs])
    weights = weights.to_numpy()
    place = {t: i for i, t in enumerate(terms.to_pylist())}
    queries, items, asked, times = (x.to_pylist() for x in row["asked"].flatten())
    by_query: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for query, item, term, n in zip(queries, items, asked, times, strict=True):
        if query not in best:
            best[query] = (item, _Best(k))
        i = place.get(term)
        if i is not None and weights[i]:
            at = slice(starts[i], starts[i + 1])
            by_query.setdefault(query, []).append((docs[at], values[at] * (n * weights[i])))
    for query, lists in by_query.items():
        search_block(lists, ids, null, best[query][1])


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """`search` of every row of `items` (item_id, text) over an index of all `docs`."""
    index = build_index(docs, shared_folder(docs.sparkSession, "lexical"))
    return search(index, query_terms(items), k)
