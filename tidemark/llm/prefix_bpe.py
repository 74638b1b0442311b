"""Byte-level BPE by prefix dynamic programming: ids of texts, exact appends, re-encoding near edits, and decoding.

The encoding of every prefix of a piece of text ends in exactly one token, and it follows from the prefixes before: a token
that ends there is the last one if the prefix before it ends in a token that it is valid beside. Two tokens are
valid neighbours if merging the bytes of both from scratch gives just these two back. So one number for each byte, the
last token of the prefix that ends there, holds the encoding of all prefixes; the ids are read off from the end. An append only
adds numbers, and after an edit the numbers are worked out again until as many as the longest token has bytes agree
with the old ones; all later ones are then the same.

Texts are cut into pieces by the vocabulary's pattern, and each piece is encoded by itself. A match of the pattern looks at no more than
two characters beyond its end, so that a change leaves all pieces that end two characters before it as they are.

Null texts are empty and have no ids. Rows with equal or null ids are encoded each by itself; extra columns are not read. A text
of any length is encoded whole: long ones go through in blocks of pieces, and a piece costs time in proportion to its bytes.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.helpers import arrow_map, no_cycle_search

#: Pieces whose ids a worker remembers; then a new memory begins and takes over what still occurs. Also of valid neighbours.
REMEMBERED = 250_000
#: Characters of the longest piece that is remembered.
REMEMBERED_LENGTH = 64
#: Pieces of one text that are encoded together, and characters of several texts.
BLOCK = 1 << 16
TOGETHER = 1 << 21
#: Bytes of an ending by which the tokens that may end at a place are found, and the sizes of the shorter ones.
TAIL = 4
SHORT = (3, 2, 1)
#: How far a match of the pattern looks beyond its end.
LOOKS_AHEAD = 2

_vocabularies: dict[tuple[str, str], Vocabulary] = {}


class _Memory(dict):
    """What `work` gives for a key. The last generation but one is forgotten."""

    def __init__(self, work, older: dict | None = None):
        super().__init__()
        self.work, self.older = work, older or {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.work(key)
        self[key] = found
        return found

    def renewed(self) -> _Memory:
        if len(self) <= REMEMBERED:
            return self
        self.older = {}
        return _Memory(self.work, dict(self))


class Vocabulary:
    """Tokens by rank, and the table of last tokens of the prefixes of a piece."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.texts = {str(rank): token for token, rank in ranks.items()}
        self.beyond = max(self.tokens) + 1
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pattern = regex.compile(pattern)
        tails: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) >= TAIL:
                tails.setdefault(token[-TAIL:], set()).add(len(token))
        #: How long the tokens with an ending are, the longest first.
        self.tails = {tail: sorted(sizes, reverse=True) for tail, sizes in tails.items()}
        self.halves = _Memory(self._halves)
        self.neighbours = _Memory(self._valid)
        self.whole = _Memory(lambda token: self._merged(self.tokens[token]) == [token])
        self.pieces = _Memory(self._piece_text)  # as decimal numbers joined by commas

    @classmethod
    def of(cls, path: str, pattern: str) -> Vocabulary:
        """The vocabulary of a file with a token in base64 and its rank in each line; read once in a process."""
        if (path, pattern) not in _vocabularies:
            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
            _vocabularies[path, pattern] = cls(ranks, pattern)
        return _vocabularies[path, pattern]

    def _merged(self, data: bytes, below: int | None = None) -> list[int]:
        """The lowest-ranked pair is merged, the leftmost of equals first, until none (of a rank below `below`) is left."""
        parts, none = [data[i : i + 1] for i in range(len(data))], self.beyond
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, none), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank >= (none if below is None else below):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes a token; None for one that no merge makes, a single byte at least."""
        parts = self._merged(self.tokens[token], below=token)
        return (parts[0], parts[1]) if len(parts) == 2 and parts[0] < token > parts[1] else None

    def _valid(self, pair: tuple[int, int]) -> bool:
        """Whether merging the joined bytes of two tokens gives just these two: no merge across their border comes first.

        The merges that make the two are undone from the last to the first. At each moment one token lies on each side of the
        border, and these two would have merged if their joint rank comes before the merges that took them up.
        """
        left, right = pair
        left_until = right_until = self.beyond
        while True:
            across = self.ranks.get(self.tokens[left] + self.tokens[right])
            if across is not None and across < left_until and across <= right_until:
                return False
            left_made, right_made = self.halves[left], self.halves[right]
            if left_made is not None and (left > right or right_made is None):
                left_until, left = left, left_made[1]
            elif right_made is not None:
                right_until, right = right, right_made[0]
            else:
                return True

    def extend(self, data: bytes, last: array, until: int | None = None) -> None:
        """Adds to `last`, the last tokens of the first prefixes of `data`, those of the further ones (to the length `until`)."""
        ranks, tails, valid, whole = self.ranks.get, self.tails.get, self.neighbours, self.whole
        for end in range(len(last) + 1, (len(data) if until is None else until) + 1):
            for size in (*tails(data[max(0, end - TAIL) : end], ()), *SHORT):
                start = end - size
                if start > 0:
                    token = ranks(data[start:end])
                    if token is not None and valid[last[start - 1], token]:
                        break
                elif start == 0:
                    token = ranks(data[:end])
                    if token is not None and whole[token]:
                        break
            else:
                raise ValueError("the vocabulary lacks a single byte")
            last.append(token)

    def read_off(self, last: array) -> list[int]:
        """The ids, from the last tokens of all prefixes."""
        ids, at = [], len(last)
        while at:
            ids.append(last[at - 1])
            at -= self.lengths[ids[-1]]
        ids.reverse()
        return ids

    def piece_ids(self, piece: str) -> list[int]:
        data, last = piece.encode(), array("i")
        self.extend(data, last)
        return self.read_off(last)

    def _piece_text(self, piece: str) -> str:
        return ",".join(map(str, self.piece_ids(piece)))

    def _learn(self, pieces: set[str]) -> None:
        """The ids of new pieces. In order, each shares a prefix with the one before, whose last tokens are there already."""
        self.neighbours, self.pieces = self.neighbours.renewed(), self.pieces.renewed()
        known, older, new = self.pieces, self.pieces.older, []
        for piece in pieces:
            if piece in known:
                continue
            if (found := older.get(piece)) is not None:
                known[piece] = found
            elif len(piece) <= REMEMBERED_LENGTH:
                new.append((piece.encode(), piece))
        new.sort()
        before, last = b"", array("i")
        for data, piece in new:
            same = 0
            for same, (a, b) in enumerate(zip(data, before, strict=False)):  # noqa: B007
                if a != b:
                    break
            else:
                same = min(len(data), len(before))
            del last[same:]
            self.extend(data, last)
            known[piece] = ",".join(map(str, self.read_off(last)))
            before = data

    def _joined(self, pieces: list[str]) -> str:
        """The ids of pieces as decimal numbers joined by commas; those that are too long to be remembered are worked out here."""
        known = self.pieces
        if max(map(len, pieces)) <= REMEMBERED_LENGTH:
            return ",".join(map(known.__getitem__, pieces))
        return ",".join([known[p] if len(p) <= REMEMBERED_LENGTH else self._piece_text(p) for p in pieces])

    def blocks(self, text: str) -> Iterator[str]:
        """The ids of a text, in blocks of pieces."""
        found = (m.group() for m in self.pattern.finditer(text))
        while pieces := list(islice(found, BLOCK)):
            self._learn(set(pieces))
            yield self._joined(pieces)

    def texts_ids(self, texts: list[str]) -> Iterator[list[str]]:
        """The ids of each text, in blocks; short texts are worked on together."""
        at, held = 0, 0
        for i, text in enumerate(texts):
            held += len(text)
            if held > TOGETHER or i + 1 == len(texts):
                with no_cycle_search():
                    short = [self.pattern.findall(t) if len(t) <= TOGETHER else None for t in texts[at : i + 1]]
                    self._learn(set().union(*filter(None, short)))
                for t, pieces in zip(texts[at : i + 1], short, strict=True):
                    yield self.blocks(t) if pieces is None else [self._joined(pieces)] if pieces else []
                at, held = i + 1, 0


class EncodedText:
    """A text with the ends of its pieces and, for each byte, the last token of the prefix of its piece that ends there."""

    def __init__(self, vocabulary: Vocabulary, text: str = "", ends: list[int] | None = None, last: array | None = None):
        self.vocabulary, self.text = vocabulary, ""
        self.ends, self.last = [], array("i")
        if ends is None:
            self.edit(0, 0, text)
        else:
            self.text, self.ends, self.last = text, list(ends), last

    def ids(self) -> list[int]:
        out, at, start = [], 0, 0
        for end in self.ends:
            size = len(self.text[start:end].encode())
            out += self.vocabulary.read_off(self.last[at : at + size])
            at, start = at + size, end
        return out

    def append(self, more: str) -> int:
        return self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, replacement: str) -> int:
        """Characters from `start` to `end` replaced. Returns for how many bytes the last token was worked out again."""
        old_text, old_ends, old_last = self.text, self.ends, self.last
        text = old_text[:start] + replacement + old_text[end:]
        shift, changed = len(text) - len(old_text), start + len(replacement)
        kept = 0
        while kept < len(old_ends) and old_ends[kept] <= start - LOOKS_AHEAD:
            kept += 1
        at = old_ends[kept - 1] if kept else 0
        ends, last = old_ends[:kept], old_last[: len(text[:at].encode())]
        boundaries, worked = {e: i for i, e in enumerate(old_ends[kept:], kept)}, 0
        if not kept:
            boundaries[0] = -1
        old_at, old_byte = at, len(last)  # the piece of the old text that the next one is compared with
        while at < len(text):
            if at >= changed and at - shift in boundaries:  # from here on the pieces are the old ones
                i = boundaries[at - shift]
                ends += [e + shift for e in old_ends[i + 1 :]]
                last += old_last[len(old_text[: at - shift].encode()) :]
                break
            stop = self.vocabulary.pattern.match(text, at).end()
            piece = text[at:stop].encode()
            if old_at is not None:
                following = old_ends[len(ends)] if len(ends) < len(old_ends) else len(old_text)
                old_piece = old_text[old_at:following].encode()
                table, n = self._near(piece, old_piece, old_last[old_byte : old_byte + len(old_piece)])
                old_at = None
            else:
                table, n = array("i"), len(piece)
                self.vocabulary.extend(piece, table)
            worked += n
            last += table
            ends.append(stop)
            at = stop
        self.text, self.ends, self.last = text, ends, last
        return worked

    def _near(self, piece: bytes, old: bytes, old_last: array) -> tuple[array, int]:
        """The table of a piece that is like an old one but for a part in the middle."""
        same = next((i for i, (a, b) in enumerate(zip(piece, old, strict=False)) if a != b), min(len(piece), len(old)))
        tail = 0
        while tail < min(len(piece), len(old)) - same and piece[-1 - tail] == old[-1 - tail]:
            tail += 1
        last, longest = old_last[:same], self.vocabulary.longest
        ahead, agree = len(piece) - tail, 0
        self.vocabulary.extend(piece, last, ahead)
        while len(last) < len(piece) and agree < longest:
            self.vocabulary.extend(piece, last, len(last) + 1)
            agree = agree + 1 if last[-1] == old_last[len(last) - 1 + len(old) - len(piece)] else 0
        worked = len(last) - same
        return last + old_last[len(last) + len(old) - len(piece) :], worked


_TABLE = "piece_ends array<int>, last_tokens array<int>"


def _text(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(name).to_pylist()]


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids (decimal, joined by commas) and of the bytes that they decode to."""

    def work(batch: pa.RecordBatch):
        vocabulary = Vocabulary.of(path, pattern)
        rows = []
        for blocks in vocabulary.texts_ids(_text(batch)):
            n, joined, decoded = 0, hashlib.sha256(), hashlib.sha256()
            for block in blocks:
                ids = block.split(",")
                joined.update((f",{block}" if n else block).encode())
                decoded.update(b"".join(map(vocabulary.texts.__getitem__, ids)))
                n += len(ids)
            rows.append((n, joined.hexdigest(), decoded.hexdigest()))
        columns = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return arrow_map(_columns(docs), work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _columns(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text, ids, piece_ends, last_tokens): the ids of every text, and the table that later changes start from."""

    def work(batch: pa.RecordBatch):
        vocabulary = Vocabulary.of(path, pattern)
        yield from _rows(batch.column("doc_id").to_pylist(), (EncodedText(vocabulary, t) for t in _text(batch)))

    return arrow_map(_columns(docs), work, f"doc_id long, text string, ids array<int>, {_TABLE}")


def _rows(doc_ids: list, texts: Iterator[EncodedText]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text", "ids", "piece_ends", "last_tokens"]
    rows, held = [], 0
    for doc, t in zip(doc_ids, texts, strict=True):
        rows.append((doc, t.text, array("i", t.ids()), array("i", t.ends), t.last))
        held += len(t.last)
        if held > 1 << 20:
            yield _batch(rows, names)
            rows, held = [], 0
    if rows:
        yield _batch(rows, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), *[pa.list_(pa.int32())] * 3]
    return pa.RecordBatch.from_arrays([pa.array([list(x) if isinstance(x, array) else x for x in c], k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def edit(encoded: DataFrame, edits: DataFrame, path: str, pattern: str) -> DataFrame:
    """`encoded` (of `encode`) after `edits`: (doc_id, start, end, replacement), at most one for a document.

    Characters from `start` to `end` (counted from 0, null: the end of the text, which makes it an append) are replaced. Only
    the tokens near an edit are worked out again. A document without an edit stays as it is; an edit of an unknown or null
    id changes nothing; several for one document fail the job.
    """
    once = edits.groupBy("doc_id").agg(F.count("*").alias("n"), F.first(F.struct("start", "end", "replacement")).alias("edit"))
    several = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("several edits of document "), F.col("doc_id").cast("string"))).cast("int"))
    joined = encoded.join(once, "doc_id", "left").select(
        "doc_id", "text", "piece_ends", "last_tokens",
        F.coalesce(several, F.when(F.col("edit").isNotNull(), 1).otherwise(0)).alias("edited"), F.col("edit.start").cast("int").alias("start"),
        F.col("edit.end").cast("int").alias("end"), F.coalesce(F.col("edit.replacement"), F.lit("")).alias("replacement"),
    )

    def work(batch: pa.RecordBatch):
        vocabulary = Vocabulary.of(path, pattern)

        def changed():
            for row in batch.to_pylist():
                t = EncodedText(vocabulary, row["text"], row["piece_ends"], array("i", row["last_tokens"]))
                if row["edited"]:
                    size = len(t.text)
                    start, end = (size if row[c] is None else max(0, min(row[c], size)) for c in ("start", "end"))
                    t.edit(start, max(start, end), row["replacement"])
                yield t

        yield from _rows(batch.column("doc_id").to_pylist(), changed())

    return arrow_map(joined, work, f"doc_id long, text string, ids array<int>, {_TABLE}")


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """(doc_id, data): the bytes that an array of ids stands for; null and empty arrays give no bytes."""

    def work(batch: pa.RecordBatch):
        tokens = Vocabulary.of(path, pattern).tokens
        data = [b"".join(map(tokens.__getitem__, x or [])) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    return arrow_map(encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(ids).alias("ids")), work, "doc_id long, data binary")
