"""Benchmark items inside documents: containment search by MinHash over partitions of similar size, verified exactly.

A short item and a long document have a small Jaccard similarity even if the document holds all of the item. So items
are partitioned by the number of their distinct shingles, in classes up to 16, 32, 64 ..., and a document is seen as windows of twice
the class's size that overlap by half; an item of the class that a document quotes lies in one of its windows, and
there the Jaccard similarity is at least 0.19 for a containment of 0.8. MINIMA minimal hashes, any of which may agree, find
such a window but for a chance of 2e-6. The minima of windows are minima of the minima of small blocks, so that
each shingle is hashed MINIMA times whatever the classes. Each candidate is then judged by the share of the item's distinct
shingles that the whole document has, compared as words. Items of up to EXACT distinct shingles would be too small a part
of their windows; every document that has one of their shingles is a candidate.

Items lie in the shared folder in chunks of bounded size (CHUNK_BYTES of text), which the tasks read; one pass over the
documents for each chunk.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.helpers import arrow_map, cut, shared_folder
from tidemark.llm.words import mix, shingle_hashes, slices, text_buffers, text_shingles, word_hashes

MINIMA = 64
BLOCK = 8
#: Items of so many distinct shingles or fewer are looked up by each of them.
EXACT = 8
CONTAINMENT = 0.8
CHUNK_BYTES = 4 << 20

_U = np.uint64
_NONE = np.iinfo(np.uint64).max
#: The i-th hash of a shingle is its product with the i-th odd factor.
_FACTORS = mix(np.arange(1, MINIMA + 1, dtype=_U)) | _U(1)


def _item_class(size: int) -> int:
    """Largest number of shingles of the items that share a class with one of `size`."""
    most = 2 * BLOCK
    while most < size:
        most *= 2
    return most


class ItemIndex:
    """Minimal hashes of the longer items of one chunk, hashes of the shingles of short ones, and all exact shingles."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.shingles = [text_shingles(t) for _, t in items]
        hashes, bounds = shingle_hashes(*word_hashes(*text_buffers(pa.array([t for _, t in items], pa.string()))))
        self.classes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        members: dict[int, list[int]] = {}
        short: list[int] = []
        for i in range(len(items)):
            if 0 < len(self.shingles[i]) <= EXACT:
                short.append(i)
            elif self.shingles[i]:
                members.setdefault(_item_class(len(self.shingles[i])), []).append(i)
        self.short: dict[int, list[int]] = {}
        for i in short:
            for h in set(hashes[bounds[i] : bounds[i + 1]].tolist()):
                self.short.setdefault(h, []).append(i)
        self.short_hashes = np.array(sorted(self.short), dtype=_U)
        for most, of in members.items():
            keys = np.stack([(hashes[bounds[i] : bounds[i + 1], None] * _FACTORS).min(axis=0) for i in of])
            # The number of the hash goes into the key, so that one sorted list serves all hashes.
            keys = mix(keys + np.arange(MINIMA, dtype=_U) * _U(0x9E3779B97F4A7C15)).reshape(-1)
            order = np.argsort(keys, kind="stable")
            self.classes[most] = keys[order], np.repeat(of, MINIMA)[order]

    def candidates(self, hashes: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) pairs, by place, of which a window and the item agree in a minimal hash, or the document and a
        short item in a shingle's."""
        counts = np.diff(bounds)
        found: set[tuple[int, int]] = set()
        if len(self.short_hashes):
            at = np.minimum(np.searchsorted(self.short_hashes, hashes), len(self.short_hashes) - 1)
            places = np.flatnonzero(self.short_hashes[at] == hashes)
            documents = np.searchsorted(bounds, places, side="right") - 1
            for d, h in set(zip(documents.tolist(), hashes[places].tolist(), strict=True)):
                found.update((d, i) for i in self.short[h])
        if not self.classes:
            return found
        blocks = -(-counts // BLOCK)
        first = np.concatenate([[0], np.cumsum(blocks)])
        document = np.repeat(np.arange(len(counts)), blocks)
        # A block at the end of a document is filled up with the document's last hash, which changes no minimum.
        within = (np.arange(int(first[-1])) - first[:-1][document]) * BLOCK + bounds[:-1][document]
        filled = np.minimum(within + np.arange(BLOCK)[:, None], bounds[1:][document] - 1)
        columns = hashes[filled]
        minima = np.empty((MINIMA, int(first[-1])), dtype=_U)
        for k in range(MINIMA):
            np.min(columns * _FACTORS[k], axis=0, out=minima[k])
        last = first[1:][document] - 1
        here = np.arange(int(first[-1]))
        offset = (np.arange(MINIMA, dtype=_U) * _U(0x9E3779B97F4A7C15))[:, None]
        for most, (keys, items) in sorted(self.classes.items()):
            step, width = most // BLOCK, 2 * most // BLOCK
            starts = here[(here - first[:-1][document]) % step == 0]
            window = minima[:, starts].copy()
            for j in range(1, width):
                np.minimum(window, minima[:, np.minimum(starts + j, last[starts])], out=window)
            sought = mix(window + offset)
            at = np.searchsorted(keys, sought.reshape(-1))
            hits = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == sought.reshape(-1))
            for h in hits:
                d = int(document[starts[h % len(starts)]])
                i = int(at[h])
                while i < len(keys) and keys[i] == keys[at[h]]:
                    found.add((d, int(items[i])))
                    i += 1
        return found


class ItemChunks:
    """The items in `n` parts of about CHUNK_BYTES of text, as a table in the shared folder; no item passes through the driver."""

    def __init__(self, items: DataFrame):
        texts = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        texts = texts.filter("item_id is not null and text is not null").distinct()
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0]
        self.folder, self.n = shared_folder(items.sparkSession, "items"), -(-(size or 0) // CHUNK_BYTES)
        if self.n:
            chunk = F.pmod(F.xxhash64("item_id", "text"), F.lit(self.n))
            texts.withColumn("chunk", chunk).repartition("chunk").write.partitionBy("chunk").parquet(self.folder)

    def index(self, chunk: int) -> Callable[[], ItemIndex]:
        """What builds the index of a chunk in a task, once for all of its batches."""
        folder, held = self.folder, []

        def build() -> ItemIndex:
            if not held:
                store, root = fs.FileSystem.from_uri(folder)
                files = store.get_file_info(fs.FileSelector(f"{root}/chunk={chunk}", allow_not_found=True))
                rows = []
                for path in sorted(f.path for f in files if f.path.endswith(".parquet")):
                    with store.open_input_file(path) as source:
                        part = pq.ParquetFile(source).read(["item_id", "text"])
                    rows += zip(part.column("item_id").to_pylist(), part.column("text").to_pylist(), strict=True)
                held.append(ItemIndex(sorted(rows)))
            return held[0]

        return build


def contained_items(
    docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT, id_column: str = "doc_id"
) -> DataFrame:
    """(doc_id, item_id, containment) of the items of which a document has that share of shingles or more.

    Five-word shingles; an item or document of fewer words is one shingle. Null or empty texts and items without
    an id take part in nothing; documents with a null id are searched like others. Items with equal texts are all found.
    Candidates are found for a containment of 0.8 or more.
    """
    if containment < CONTAINMENT:
        raise ValueError("windows and minima find containments of 0.8 or more")
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, containment double"
    chunks = ItemChunks(items)
    found = None
    for chunk in range(chunks.n):
        part = arrow_map(docs, _search(chunks.index(chunk), containment), schema)
        found = part if found is None else found.union(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def _search(build: Callable[[], ItemIndex], containment: float):
    def work(batch: pa.RecordBatch):
        index = build()
        for part in slices(batch, "text"):
            hashes, bounds = shingle_hashes(*word_hashes(*text_buffers(part.column("text"))))
            rows, held = [], {}
            for d, i in sorted(index.candidates(hashes, bounds)):
                if d not in held:
                    held = {d: text_shingles(part.column("text")[d].as_py())}
                share = len(index.shingles[i] & held[d]) / len(index.shingles[i])
                if share >= containment:
                    rows.append((part.column("doc_id")[d].as_py(), index.ids[i], share))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["doc_id", "item_id", "containment"],
                )

    return work


def decontaminate(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """The rows of `docs`, all columns, whose texts hold no item. Each row is judged by its own text, whatever its id."""
    chunks = ItemChunks(items)
    for chunk in range(chunks.n):
        docs = arrow_map(docs, _clean(chunks.index(chunk), containment), docs.schema)
    return docs


def _clean(build: Callable[[], ItemIndex], containment: float):
    def work(batch: pa.RecordBatch):
        index = build()
        for part in slices(batch, "text"):
            texts = part.column("text")
            clean = np.ones(part.num_rows, dtype=bool)
            held = {}
            for d, i in sorted(index.candidates(*shingle_hashes(*word_hashes(*text_buffers(texts))))):
                if clean[d]:
                    if d not in held:
                        held = {d: text_shingles(texts[d].as_py())}
                    clean[d] = len(index.shingles[i] & held[d]) / len(index.shingles[i]) < containment
            yield part if clean.all() else part.filter(pa.array(clean))

    return work


def report(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, n_items, item_id, containment) for every row: how many items it holds, and the one that it holds most of."""
    found = contained_items(docs, items, containment)
    best = Window.partitionBy("doc_id").orderBy(F.desc("containment"), "item_id")
    held = cut(
        found.distinct().withColumn("n_items", F.count("*").over(Window.partitionBy("doc_id")))
        .withColumn("nth", F.row_number().over(best)).filter("nth = 1").drop("nth")
    )
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(held, "doc_id", "left").select(
        "doc_id", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "item_id", "containment"
    )


