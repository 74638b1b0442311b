"""Packing tokenized documents into sequences: best fit over the counts of lengths, then swap-based local search.

Lengths are whole numbers up to the capacity, so that a plan for all documents needs only the number of pieces of each
length: at most `capacity` numbers, whatever the size of the corpus. The plan is a list of patterns (lengths that
share a sequence) with the number of sequences that follow each. Pieces are then ranked within their length on
the cluster, and the rank tells the sequence and the place in it.
"""

from __future__ import annotations

import json
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.helpers import arrow_map, cut

CAPACITY = 1024
END_ID = 2
#: Pieces of one length that one task ranks, about.
RANKED_TOGETHER = 8192

#: The pattern that byte-level splitting uses (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[str, TextEncoder] = {}


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter stands for in byte-level vocabularies: itself if it prints, else one from U+0100 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + n): b for n, b in enumerate(others)}


class TextEncoder:
    """Token ids of texts as little-endian 32-bit numbers, by a tokenizers file.

    Plain byte-level vocabularies whose ids follow the order of the merges are read by the ranks of their tokens, which gives the same ids in
    less time and without a memory of words. Other vocabularies, and texts that the ranks' pattern gives up on (very long runs
    of white space), go through the tokenizer itself.
    """

    def __init__(self, path: str):
        self.path, self._tokenizer = path, None
        with open(path, encoding="utf-8") as file:
            self.by_rank = self._ranked(json.load(file))

    @property
    def tokenizer(self):
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self.path)
        return self._tokenizer

    @staticmethod
    def _ranked(parts: dict):
        import tiktoken

        model, split = parts["model"], parts["pre_tokenizer"]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        options = ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges", "dropout")
        if model.get("type", "BPE") != "BPE" or not model.get("merges") or parts["normalizer"] is not None:
            return None
        if split is None or any(split.get(k) != v for k, v in plain.items()) or any(model.get(k) for k in options):
            return None
        special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in parts["added_tokens"]):
            return None
        vocabulary = model["vocab"]
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        letters = _byte_of_letter()
        if merged != sorted(merged) or any(vocabulary.get(c, len(vocabulary)) >= merged[0] for c in letters):
            return None
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in vocabulary.items() if t not in special}
        if len(merged) + len(letters) != len(ranks):
            return None
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> bytes:
        if self.by_rank is not None:
            try:
                return self.by_rank.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
            except ValueError:
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def _encoder(path: str) -> TextEncoder:
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document: its ids and then `end_id`.

    A document longer than the capacity is cut into pieces of that length, the first of which takes what is left over. A
    null text is an empty one, and has the end id alone. `tokenizer` is the path of a tokenizers file on every machine.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def work(batch: pa.RecordBatch):
        encoder = _encoder(tokenizer)
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            data = encoder.encode(text or "") + end
            total = len(data) // 4
            cuts = [0, *range(total % capacity or capacity, total, capacity), total]
            for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                rows.append((doc, piece, a, b - a, zlib.crc32(data[4 * a : 4 * b])))
        columns = list(zip(*rows, strict=True))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"]
        )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(columns, work, "doc_id long, piece int, start long, length long, ids_crc32 long")


Pattern = tuple[int, ...]


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> dict[Pattern, int]:
    """Best fit in descending order for all pieces of a length at once: {pattern: number of sequences}.

    Each length splits at most two groups of equal sequences, so that there are no more than about twice as
    many patterns as lengths.
    """
    open_groups: list[dict[Pattern, int]] = [{} for _ in range(capacity + 1)]  # by the room left

    def put(pattern: Pattern, times: int) -> None:
        group = open_groups[capacity - sum(pattern)]
        group[pattern] = group.get(pattern, 0) + times

    for length in sorted(counts, reverse=True):
        left = counts[length]
        room = length
        while left and room <= capacity:
            if not open_groups[room]:
                room += 1
                continue
            pattern, times = open_groups[room].popitem()
            used = min(times, left)
            if times > used:
                open_groups[room][pattern] = times - used
            put((*pattern, length), used)
            left -= used
            room = length
        each = capacity // length
        if left >= each:
            put((length,) * each, left // each)
        if left % each:
            put((length,) * (left % each), 1)
    plan: dict[Pattern, int] = {}
    for group in open_groups:
        for pattern, times in group.items():
            pattern = tuple(sorted(pattern, reverse=True))
            plan[pattern] = plan.get(pattern, 0) + times
    return plan


def _exchange(one: Pattern, two: Pattern, capacity: int) -> tuple[Pattern, Pattern] | None:
    """The exchange between two sequences that raises the sum of squared fills most, if any does.

    `one` gains: it takes one or two lengths of `two` and gives none, one or two of its own.
    """
    room, gap = capacity - sum(one), sum(two) - sum(one)
    give = sorted({(), *((a,) for a in one), *((a, b) for i, a in enumerate(one) for b in one[i + 1 :])}, key=sum)
    take = {(a,) for a in two} | {(a, b) for i, a in enumerate(two) for b in two[i + 1 :]}
    best, found = 0, None
    for t in take:
        for g in give:
            if len(t) + len(g) > 3:
                continue
            gain = sum(t) - sum(g)
            if gain <= 0:
                break
            if gain <= room and gain > gap and gain * (gain - gap) > best:
                best, found = gain * (gain - gap), (t, g)
    if found is None:
        return None
    one_left, two_left = list(one), list(two)
    for x in found[0]:
        two_left.remove(x)
    for x in found[1]:
        one_left.remove(x)
    return (
        tuple(sorted([*one_left, *found[0]], reverse=True)),
        tuple(sorted([*two_left, *found[1]], reverse=True)),
    )


def local_search(plan: dict[Pattern, int], capacity: int = CAPACITY) -> dict[Pattern, int]:
    """Exchange, move, and two-for-one exchanges between underfull sequences until none raises the sum of squared
    fills or the number of sequences has reached the bound that the total length sets.

    An exchange is made in as many sequences of the two patterns as both have. The emptiest sequences are worked on
    first, because they are the next to become empty. Each exchange raises the sum of squares, so the search ends.
    """
    plan = dict(plan)
    bound = math.ceil(sum(sum(p) * n for p, n in plan.items()) / capacity)
    total, tried = sum(plan.values()), set()
    while total > bound:
        open_ones = sorted((p for p in plan if sum(p) < capacity), key=lambda p: (sum(p), p))
        for two, one in ((b, a) for k, b in enumerate(open_ones) for a in reversed(open_ones[k:])):
            if (one, two) in tried:
                continue
            times = plan[one] // 2 if one == two else min(plan[one], plan[two])
            after = _exchange(one, two, capacity) if times else None
            if after is None:
                if times:
                    tried.add((one, two))
                continue
            for p in (one, two):
                plan[p] -= times
                if not plan[p]:
                    del plan[p]
            for p in after:
                if p:
                    plan[p] = plan.get(p, 0) + times
                else:
                    total -= times
            break
        else:
            break
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` with sequence_id and offset.

    `pieces` is read more than once; its rows are told apart by doc_id, piece and ids_crc32, and rows that are equal in
    all three may change places.
    """
    pieces = cut(pieces)
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # `capacity` rows at most
    plan = local_search(best_fit(counts, capacity), capacity)
    slots, used, base = [], dict.fromkeys(counts, 0), 0
    for pattern, times in sorted(plan.items(), reverse=True):
        offset = 0
        for length in pattern:
            slots.append((length, used[length], base, offset))
            used[length] += times
            offset += length
        base += times
    slots.sort()
    lengths, ranks, bases, offsets = (np.array(c, dtype=np.int64) for c in zip(*slots, strict=True)) if slots else [np.zeros(0, dtype=np.int64)] * 4
    keys = (lengths << 48) + ranks  # one entry for each place of each pattern

    def work(batch: pa.RecordBatch):
        length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
        at = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(bases[at] + rank - ranks[at]), pa.array(offsets[at])],
            [*batch.schema.names[:-1], "sequence_id", "offset"],
        )

    parts = max(1, math.ceil(max(counts.values(), default=0) / RANKED_TOGETHER))
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    sizes = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("nth", F.row_number().over(within)).join(starts, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth") - 1).alias("rank")
    )
    return arrow_map(
        ranked, work,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document with their sequences; an empty table gives no row."""
    return pack(token_pieces(docs, tokenizer, capacity, end_id), capacity)


