"""Removal of byte strings that occur more than once in a corpus, found with suffix arrays of candidate contexts.

A string of `length` bytes that starts at two places is found in three steps.

1. In each text, the places with the least hash of WINDOW neighbouring ones become anchors, with the CORE bytes from there as
   their core. Every string of `length` bytes holds an anchor (the one that its own bytes choose), so that equal strings
   share an anchor at the same place. Only anchors whose core occurs more than once go on.
2. An anchor's context is its core with NEED bytes before and behind it. The strings that hold the core are runs of NEED
   bytes around it. Of equal contexts, copies of texts for the most part, all strings are repeated, and one stands for all.
3. The different contexts of a core become one text, in which a single symbol stands for the core; its suffix array shows which
   runs occur more than once. A core with more than TOGETHER different contexts is replaced by two longer ones, by half
   of the bytes on either side, until few contexts share one. So no task ever holds a group that grows with the corpus.

Cores and contexts are told apart by 128 bits of hashes; runs are compared byte by byte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.helpers import arrow_map, cut, text_of, workers_find_package
from tidemark.llm.suffixes import suffix_arrays
from tidemark.llm.words import mix, slices, text_buffers

LENGTH = 200
CORE, WINDOW = 136, 65
NEED = LENGTH - CORE
#: Different contexts that one suffix array takes; a core with more of them is split.
TOGETHER = 24
#: Symbols of the texts that a task sorts at the same time.
SYMBOLS = 1_500_000

_U = np.uint64
#: Bytes of a text that are hashed at once.
SEGMENT = 1 << 20
#: What is read before and behind a segment: all that chooses an anchor in it, and the anchor's context.
EDGE = 2 * LENGTH
_BASES = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)


def _tables(base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    up, down = np.full(SEGMENT + 2 * EDGE, base, dtype=_U), np.full(SEGMENT + 2 * EDGE, pow(base, -1, 1 << 64), dtype=_U)
    up[0] = down[0] = 1
    letters = mix(np.arange(256, dtype=_U) + _U(base & 0xFFFF))
    return np.multiply.accumulate(up), np.multiply.accumulate(down), letters


_held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []


def _hashers(data: np.ndarray):
    """Two functions that hash substrings of `data` (SEGMENT + 2 * EDGE bytes at most) by their starts and ends."""
    if not _held:
        _held.extend(_tables(b) for b in _BASES)

    def hasher(up, down, letters):
        total = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum(letters[data] * up[: len(data)], out=total[1:])
        return lambda starts, ends: mix((total[ends] - total[starts]) * down[starts])

    return [hasher(*t) for t in _held]


def _over_windows(values: np.ndarray, fold: np.ufunc, empty: int) -> np.ndarray:
    """The least or greatest of each WINDOW neighbours, from running ones of blocks in both directions."""
    n = len(values)
    padded = np.full(-(-n // WINDOW) * WINDOW, empty, dtype=_U)
    padded[:n] = values
    blocks = padded.reshape(-1, WINDOW)
    before = fold.accumulate(blocks, axis=1).reshape(-1)
    behind = fold.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return fold(behind[: n - WINDOW + 1], before[WINDOW - 1 : n])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, core hashes and context hashes of the anchors of SEGMENT + 2 * EDGE bytes at most."""
    n = len(data) - CORE + 1
    if n < WINDOW:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=_U), np.zeros(0, dtype=_U)
    one, two = _hashers(data)
    starts = np.arange(n)
    hashes = one(starts, starts + CORE)
    least = _over_windows(hashes, np.minimum, np.iinfo(np.uint64).max)
    edge = np.zeros(WINDOW - 1, dtype=_U)
    # A place is an anchor if it has the least hash of any of the windows that hold it.
    at = np.flatnonzero(hashes == _over_windows(np.concatenate([edge, least, edge]), np.maximum, 0))
    low, high = np.maximum(at - NEED, 0), np.minimum(at + CORE + NEED, len(data))
    return at, hashes[at], mix(two(low, high) + ((at - low) * 1024 + (high - at)).astype(_U))


def _rows(docs: DataFrame) -> DataFrame:
    """(doc, hash, text): what tells rows apart, and the text with null as empty. The hash only parts rows of one id."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return docs.select(doc.alias("doc"), F.hash(text_of()).alias("hash"), text_of().alias("text"))


def _anchor_rows(rows: DataFrame) -> DataFrame:
    def work(batch: pa.RecordBatch):
        for part in slices(batch, "text"):
            data, offsets = text_buffers(part.column("text"))
            owners, columns = [], []
            for i in range(part.num_rows):
                for a in range(offsets[i], offsets[i + 1], SEGMENT):
                    begin = max(offsets[i], a - EDGE)
                    places, cores, contexts = anchors(data[begin : min(offsets[i + 1], a + SEGMENT + EDGE)])
                    places += begin - a
                    own = (places >= 0) & (places < SEGMENT)
                    if own.any():
                        owners.append(np.full(int(own.sum()), i))
                        columns.append((places[own] + (a - offsets[i]), cores[own], contexts[own]))
            if owners:
                take = pa.array(np.concatenate(owners))
                place, core, context = (np.concatenate(c) for c in zip(*columns, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(core.view(np.int64)), pa.array(context.view(np.int64)), part.column("doc").take(take),
                        part.column("hash").take(take), pa.array(place.astype(np.int32)),
                    ],
                    ["core", "context", "doc", "hash", "place"],
                )

    return arrow_map(rows, work, "core long, context long, doc long, hash int, place int")


def _contexts(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """(key, left, right, doc, hash, first, many) of the anchors in the column open of `lists`, once each."""

    def work(batch: pa.RecordBatch):
        out = []
        for doc, key, text, of in zip(*(batch.column(c) for c in ("doc", "hash", "text", "open")), strict=True):
            data = text.as_py().encode()
            for x in of.as_py():
                p = x["place"]
                left = data[max(0, p - NEED) : p].rjust(NEED, b"\xff")
                right = data[p + CORE : p + CORE + NEED].ljust(NEED, b"\xff")
                out.append((x["core"], left, right, doc.as_py(), key.as_py(), p - NEED, x["many"]))
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.bool_())
        names = ["key", "left", "right", "doc", "hash", "first", "many"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names
        )

    some = lists.filter(F.size("open") > 0).select("doc", "hash", "open")
    return arrow_map(
        rows.join(some, ["doc", "hash"]), work,
        "key long, left binary, right binary, doc long, hash int, first long, many boolean",
    )


def repeated_runs(groups: list[list[tuple[bytes, bytes]]], need: int) -> list[list[np.ndarray]]:
    """For each context (left, right) of each group, which of its need + 1 runs another of the group has too."""
    width = 2 * need + 2
    parts = []
    for contexts in groups:
        for left, right in contexts:
            parts += [left, b"\xfe", right, b"\xfd"]
        parts.append(b"\xfc")
    raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
    # UTF-8 has no byte above 0xf4; 0xff stands for what is beyond a text, 0xfe for the core, 0xfd for an end.
    symbols = np.where(raw >= 0xFC, raw - 0xFC, raw + 4).astype(np.uint8)
    sizes = np.array([len(g) * width + 1 for g in groups])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    order = suffix_arrays(symbols.astype(np.int64), bounds)
    text = np.repeat(np.arange(len(groups)), sizes)
    within = np.arange(len(symbols)) - bounds[:-1][text]
    is_run = within % width <= need
    is_run[bounds[1:] - 1] = False
    one, two = order[:-1], order[1:]
    near = np.flatnonzero(is_run[one] & is_run[two] & (text[one] == text[two]))
    one, two = one[near], two[near]
    for k in range(need + 1):  # pairs that differ fall out
        same = symbols[one + k] == symbols[two + k]
        if not same.all():
            one, two = one[same], two[same]
    repeated = np.zeros(len(symbols), dtype=bool)
    repeated[one] = repeated[two] = True
    return [
        [repeated[bounds[g] + c * width : bounds[g] + c * width + need + 1] for c in range(len(contexts))]
        for g, contexts in enumerate(groups)
    ]


def _sorted_out(contexts: DataFrame, need: int) -> DataFrame:
    """(doc, hash, low, high): runs of starts of repeated strings, of the contexts that occur once."""

    def flush(groups: list[list[tuple]]):
        found = repeated_runs([[(r[1], r[2]) for r in g] for g in groups], need)
        rows = []
        for group, masks in zip(groups, found, strict=True):
            for (_, left, right, doc, key, first, many), mask in zip(group, masks, strict=True):
                if many or not mask.any():
                    continue
                mask = mask.copy()
                mask[: left.count(b"\xff")] = False
                mask[need + 1 - right.count(b"\xff") :] = False
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
                rows += [(doc, key, first + a, first + b - 1) for a, b in edges.reshape(-1, 2).tolist()]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc", "hash", "low", "high"]
        )

    def run(batches):
        groups, symbols = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not groups or groups[-1][0][0] != row[0]:
                    if symbols >= SYMBOLS:
                        yield flush(groups)
                        groups, symbols = [], 0
                    groups.append([])
                groups[-1].append(row)
                symbols += 2 * need + 2
        if groups:
            yield flush(groups)

    workers_find_package(contexts.sparkSession)
    dealt = contexts.select("key", "left", "right", "doc", "hash", "first", "many").repartition("key")
    return dealt.sortWithinPartitions("key").mapInArrow(run, "doc long, hash int, low long, high long")


def _halves(contexts: DataFrame, need: int) -> DataFrame:
    """Each context with a core that is longer by half of its bytes, once to the left and once to the right."""
    grown = need - need // 2
    rest = need - grown
    # rest bytes stay on either side
    left = F.struct(
        F.xxhash64("key", F.lit(0), F.substring("left", need - grown + 1, grown)).alias("key"),
        F.substring("left", 1, rest).alias("left"), F.substring("right", 1, rest).alias("right"),
        F.col("first"),
    )
    right = F.struct(
        F.xxhash64("key", F.lit(1), F.substring("right", 1, grown)).alias("key"),
        F.substring("left", grown + 1, rest).alias("left"), F.substring("right", grown + 1, rest).alias("right"),
        (F.col("first") + grown).alias("first"),
    )
    return contexts.select("doc", "hash", "many", F.explode(F.array(left, right)).alias("half")).select(
        "half.*", "doc", "hash", "many"
    )


def _anchor_lists(rows: DataFrame) -> DataFrame:
    """(doc, hash, places, open) of rows with repeated cores: the anchors whose context occurs elsewhere too, and
    (place, core, many) of those that stand for their context where a core has contexts that occur once."""
    core, context = Window.partitionBy("core"), Window.partitionBy("core", "context")
    found = (
        _anchor_rows(rows)
        .withColumn("n", F.count("*").over(core)).filter("n > 1")
        .withColumn("many", F.count("*").over(context) > 1)
        .withColumn("nth", F.row_number().over(context.orderBy("doc", "hash", "place")))
        .withColumn("single", F.max(~F.col("many")).over(core))
    )
    stands = F.col("single") & (F.col("nth") == 1)
    return found.filter(F.col("many") | stands).groupBy("doc", "hash").agg(
        F.collect_list(F.when(F.col("many"), F.col("place"))).alias("places"),
        F.collect_list(F.when(stands, F.struct("place", "core", "many"))).alias("open"),
    )


def _sized(contexts: DataFrame) -> DataFrame:
    """Different contexts of the keys that have several, one of them at least occurring once, with their number n."""
    key, whole = Window.partitionBy("key"), Window.partitionBy("key", "left", "right")
    return (
        contexts.withColumn("nth", F.row_number().over(whole.orderBy("doc", "hash", "first"))).filter("nth = 1")
        .withColumn("n", F.count("*").over(key)).withColumn("single", F.max(~F.col("many")).over(key))
        .filter("n > 1 and single").drop("nth", "single")
    )


def repeated_ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of `docs` (doc, hash, text); (doc, hash, places), anchors all of whose strings are repeated; and (doc, hash,
    low, high), other runs of starts of repeated strings."""
    rows = _rows(docs)
    lists = cut(_anchor_lists(rows))
    work, need, ranges = _contexts(rows, lists), NEED, []
    while True:
        sized = cut(_sized(work))
        ranges.append(cut(_sorted_out(sized.filter(F.col("n") <= TOGETHER), need)))
        large = sized.filter(F.col("n") > TOGETHER)
        if need == 0 or large.isEmpty():
            break
        halves = cut(_halves(large, need))
        need //= 2
        whole = ["key", "left", "right"]
        merged = halves.groupBy(*whole).agg(
            (F.max("many") | (F.count("*") > 1)).alias("many"), F.min(F.struct("doc", "hash", "first")).alias("one")
        )
        alike = halves.filter("not many").join(merged.filter("many").select(*whole), whole)
        ranges.append(alike.select("doc", "hash", F.col("first").alias("low"), (F.col("first") + need).alias("high")))
        work = merged.select(*whole, "one.*", "many")
    marks = ranges[0]
    for r in ranges[1:]:
        marks = marks.union(r)
    return rows, lists.select("doc", "hash", "places"), marks


def remove_repeats(docs: DataFrame, kept_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row; with `kept_text` also kept, the bytes left.

    Each byte that lies in a string of LENGTH bytes which also starts elsewhere, in the same text or another, is removed. A null
    text is empty; doc_id may be null or repeated, and rows that repeat a long text lose it all. Spans are maximal runs.
    """
    rows, lists, marks = repeated_ranges(docs)
    marks = marks.groupBy("doc", "hash").agg(F.collect_set(F.struct("low", "high")).alias("of"))
    lists = lists.join(marks, ["doc", "hash"], "full")

    def work(batch: pa.RecordBatch):
        out = []
        for doc, text, places, of in zip(*(batch.column(c) for c in ("doc_id", "text", "places", "of")), strict=True):
            data = text.as_py().encode()
            removed, spans, kept, at = 0, 0, [], 0
            starts = [(p - NEED, p) for p in places.as_py() or ()] + [(x["low"], x["high"]) for x in of.as_py() or ()]
            for low, high in sorted(starts):
                low, high = max(low, 0), min(high, len(data) - LENGTH)
                if low > high:
                    continue
                if low > at or not spans:
                    kept.append(data[at:low])
                    spans += 1
                    at = low
                removed += max(0, high + LENGTH - at)
                at = max(at, high + LENGTH)
            kept = b"".join([*kept, data[at:]])
            out.append((doc.as_py(), len(data), removed, spans, hashlib.sha256(kept).hexdigest(), kept)[: 6 if kept_text else 5])
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        width = len(out[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds[:width], strict=True)], names[:width]
        )

    joined = rows.join(lists, ["doc", "hash"], "left").select(
        F.when(F.col("doc") > -(1 << 63), F.col("doc")).alias("doc_id"), "text", "places", "of"
    )
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return arrow_map(joined, work, schema + ", kept binary" * kept_text)
