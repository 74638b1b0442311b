"""Words and word shingles of Arrow text columns as 64-bit hashes, worked out with numpy for a whole batch.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return in the
UTF-8 text, with A-Z lower-cased. Null and empty texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
#: Bytes of text that are hashed at once; the temporary arrays take some 40 times as much.
SEGMENT = 1 << 21

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: One odd factor for each place in a shingle.
_PLACE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=_U)
_powers: tuple[np.ndarray, np.ndarray] | None = None


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for the positions of one segment."""
    global _powers
    if _powers is None:
        up, down = np.full(SEGMENT + 1, _BASE, dtype=_U), np.full(SEGMENT + 1, pow(_BASE, -1, 1 << 64), dtype=_U)
        up[0] = down[0] = 1
        _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the n + 1 places at which its texts begin and end. Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _IS_WORD[data]
    first = inside[1:] & ~inside[:-1]
    breaks = offsets[1:-1]
    first[breaks] = inside[breaks + 1]
    starts = np.flatnonzero(first[:-1])
    last = inside[:-1] & ~inside[1:]
    last[breaks] |= inside[breaks]
    return starts, np.flatnonzero(last)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and the n + 1 places among them at which the words of each text begin and end."""
    starts, ends = _spans(data, offsets)
    out = np.empty(len(starts), dtype=_U)
    up, down = _power_tables()
    i = 0
    while i < len(starts):
        base = starts[i]
        j = int(np.searchsorted(ends, base + SEGMENT, side="right"))
        if j <= i:  # one word longer than a segment
            out[i] = _long_word(data[base : ends[i]])
            i += 1
            continue
        part = _LOWER[data[base : ends[j - 1]]].astype(_U)
        part += _U(1)
        part *= up[: len(part)]
        total = np.zeros(len(part) + 1, dtype=_U)
        np.cumsum(part, out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (total[e] - total[s]) * down[s]
        i = j
    out ^= (ends - starts).astype(_U) * _U(_BASE)
    return mix(out), np.searchsorted(starts, offsets)


def _long_word(data: np.ndarray) -> np.uint64:
    up, _ = _power_tables()
    value = 0
    for k in range(0, len(data), SEGMENT):
        part = (_LOWER[data[k : k + SEGMENT]].astype(_U) + _U(1)) * up[: min(SEGMENT, len(data) - k)]
        value += int(part.sum(dtype=_U)) * pow(_BASE, k, 1 << 64)
    return _U(value & ((1 << 64) - 1))


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each shingle in text order, and the n + 1 places of the texts.

    A text with fewer words than `size` has its whole sequence as one shingle; one without words has none.
    """
    counts = np.diff(bounds)
    if not len(words):
        return np.zeros(0, dtype=_U), np.zeros(len(bounds), dtype=np.int64)
    padded = np.concatenate([words, np.zeros(size - 1, dtype=_U)])
    whole = np.zeros(len(words), dtype=_U)
    for k in range(size):
        whole += padded[k : k + len(words)] * _PLACE[k]
    keep = np.ones(len(words), dtype=bool)
    for k in range(1, size):  # the last words of a text begin no shingle
        at = bounds[1:][counts >= k] - k
        keep[at] = False
    short = np.flatnonzero((counts > 0) & (counts < size))
    for d in short:
        w = words[bounds[d] : bounds[d + 1]]
        whole[bounds[d]] = (w * _PLACE[: len(w)]).sum(dtype=_U) + _U(len(w))
        keep[bounds[d]] = True
    n = np.maximum(counts - size + 1, counts > 0)
    return mix(whole[keep]), np.concatenate([[0], np.cumsum(n)]).astype(np.int64)


def slices(batch: pa.RecordBatch, column: str, limit: int = SEGMENT) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose texts hold about `limit` bytes at most; a longer text makes a piece by itself."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(sizes)])
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(total, total[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def text_words(text: str | None) -> list[bytes]:
    """The words of one text as bytes, for exact comparison. split() of bytes cuts at the same six bytes, and lower() changes A-Z alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def text_shingles(text: str | None, size: int = SHINGLE) -> set[bytes]:
    """The distinct shingles of one text, each as its words with single spaces; words hold no space."""
    words = text_words(text)
    if not words:
        return set()
    if len(words) < size:
        return {b" ".join(words)}
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}
