"""Zstandard-compressed WARC archives: a writer, and a reader that checks what it reads.

An archive begins with a skippable frame that holds the dictionary; each record then is a frame of its own, so that a
reader can start at any record. Archives are files in a folder that all executors share. Their names hold the attempt of
the task that wrote them, and the list of archives holds those of the attempts that counted, so that the files of a lost
or repeated task are never read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.helpers import arrow_map, cut, text_of, workers_find_package

#: Frame that holds the dictionary: its magic number and, inside, that of a compressed one.
SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
#: A record is repeated as a revisit only if its payload has so many bytes.
SHORTEST_REVISIT = 1000
#: Payload bytes of the rows that one archive takes, about.
ARCHIVE_BYTES = 32 << 20
#: An archive's dictionary is drawn from its first records, so many bytes of them at most.
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 64 << 10
READ_BYTES = 1 << 20

_END = b"\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive or record that breaks the format, with the place at which it does."""


def _record_id(key: int | None) -> str:
    return f"<urn:page:{'none' if key is None else key}>"


def record_bytes(key: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str) -> bytes:
    """One record: a response with the payload, or a revisit with the HTTP head alone."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(key)}",
        "WARC-Date: 2024-01-01T00:00:00Z",
        "WARC-Target-URI: " + " ".join((url or "about:blank").split()),
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines[-2:-2] = [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    return "\r\n".join(lines).encode() + _END * 2 + block + _END * 2


def _train(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:  # too few or too small samples: their own bytes serve as the dictionary
        raw = b"".join(samples)[:DICTIONARY_BYTES] or b"WARC/1.1"
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Writes records to an open binary file; the first SAMPLE_BYTES wait until the dictionary is made."""

    def __init__(self, sink):
        self.sink, self.waiting, self.held, self.compressor = sink, [], 0, None

    def add(self, record: bytes) -> None:
        if self.compressor is not None:
            self.sink.write(self.compressor.compress(record))
            return
        self.waiting.append(record)
        self.held += len(record)
        if self.held >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        made = _train(self.waiting)
        frame = zstandard.ZstdCompressor(level=9).compress(made.as_bytes())
        self.sink.write(struct.pack("<II", SKIPPABLE, len(frame)) + frame)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=made, write_checksum=True, write_content_size=True)
        for record in self.waiting:
            self.sink.write(self.compressor.compress(record))
        self.waiting = []

    def close(self) -> None:
        if self.compressor is None:
            self._begin()


def _fill(source, data: bytes, size: int) -> bytes:
    while len(data) < size and (more := source.read(max(READ_BYTES, size - len(data)))):
        data += more
    return data


def _dictionary(source) -> tuple[zstandard.ZstdCompressionDict | None, bytes]:
    """The dictionary of the leading skippable frame, and what was read beyond it."""
    data = _fill(source, b"", 8)
    if len(data) < 8 or struct.unpack("<I", data[:4])[0] != SKIPPABLE:
        return None, data
    size = struct.unpack("<I", data[4:8])[0]
    data = _fill(source, data, 8 + size)
    frame = data[8 : 8 + size]
    if len(frame) < size:
        raise WarcError("the dictionary's frame ends early")
    if frame[:4] == ZSTD_MAGIC:
        frame = zstandard.ZstdDecompressor().decompress(frame)
    return zstandard.ZstdCompressionDict(frame), data[8 + size :]


def read_records(source) -> Iterator[bytes]:
    """The decoded records of an open archive, one frame each; no more than one record is held."""
    made, data = _dictionary(source)
    decompressor = zstandard.ZstdDecompressor(dict_data=made) if made else zstandard.ZstdDecompressor()
    at = 0
    while data := data or source.read(READ_BYTES):
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not data and not (data := source.read(READ_BYTES)):
                raise WarcError(f"record {at}: its frame ends early")
            try:
                parts.append(frame.decompress(data))
            except zstandard.ZstdError as e:
                raise WarcError(f"record {at}: {e}") from e
            data = frame.unused_data if frame.eof else b""
        yield b"".join(parts)
        at += 1


def parse_record(record: bytes) -> dict:
    """Fields of one record; its version, headers, lengths, end and (of a response) payload digest must be right."""
    head, gap, rest = record.partition(_END * 2)
    lines = head.split(_END)
    if not gap or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise WarcError(f"no WARC head: {record[:40]!r}")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"bad header line {line[:60]!r}")
        fields[name.decode("ascii", "replace").lower()] = value.strip().decode("utf-8", "replace")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise WarcError(f"no {name}")
    if not fields["content-length"].isdecimal() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != _END * 2:
        raise WarcError(f"{fields['warc-record-id']}: the block is not as long as its header says")
    http, gap, payload = rest[:-4].partition(_END * 2)
    length = [x.partition(b":")[2].strip() for x in http.split(_END) if x.lower().startswith(b"content-length:")]
    if not gap or not length or not length[0].isdigit():
        raise WarcError(f"{fields['warc-record-id']}: no HTTP head with a length")
    algorithm, _, coded = fields.get("warc-payload-digest", "").partition(":")
    try:
        digest = base64.b32decode(coded, casefold=True).hex() if algorithm == "sha1" else ""
    except (ValueError, binascii.Error):
        digest = ""
    if len(digest) != 40:
        raise WarcError(f"{fields['warc-record-id']}: no SHA-1 payload digest")
    if fields["warc-type"] == "response" and (len(payload) != int(length[0]) or hashlib.sha1(payload).hexdigest() != digest):
        raise WarcError(f"{fields['warc-record-id']}: the payload is not the one that its headers name")
    if fields["warc-type"] == "revisit" and (payload or "warc-refers-to" not in fields):
        raise WarcError(f"{fields['warc-record-id']}: a revisit with a payload or without the record that it repeats")
    return fields | {"digest": digest, "length": int(length[0]), "payload": payload}


def _key(record_id: str | None) -> int | None:
    value = (record_id or "").removeprefix("<urn:page:").removesuffix(">")
    return None if value in ("", "none") else int(value)


def plan_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, refers_to): which rows repeat the payload of another.

    Of payloads that are equal and have SHORTEST_REVISIT bytes or more, the row with the largest page_id is the response.
    Of rows that repeat that page_id too, all are responses.
    """
    html = text_of("html")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.sha1(F.encode(html, "UTF-8")).alias("digest"), F.octet_length(html).alias("bytes"),
    )
    last = (
        rows.filter(F.col("bytes") >= SHORTEST_REVISIT).groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).filter("n > 1").select("digest", "bytes", "last")
    )
    return rows.join(last, ["digest", "bytes"], "left").select(
        "page_id", "url", "html", "digest",
        F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("last")), F.col("last")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes `records` (see plan_records) to archives in `folder`, a URI that every executor can write to.

    Returns (path, records) of each archive. A task writes one archive after another, each of about ARCHIVE_BYTES.
    """
    work_id = uuid.uuid4().hex[:8]

    def write(batches):
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        done, writer, sink, size, count, name = [], None, None, 0, 0, ""

        def close():
            writer.close()
            sink.close()
            store.move(f"{root}/{name}.open", f"{root}/{name}")
            done.append((f"{root}/{name}", count))

        for batch in batches:
            for row in batch.to_pylist():
                if writer is None:
                    name = f"{work_id}-{part:06d}-{attempt}-{len(done):06d}.warc.zst"
                    sink = store.open_output_stream(f"{root}/{name}.open", compression=None)
                    writer, size, count = ArchiveWriter(sink), 0, 0
                payload = row["html"].encode()
                writer.add(record_bytes(row["page_id"], row["url"], payload, row["refers_to"], row["digest"]))
                size, count = size + len(payload) + 400, count + 1
                if size >= ARCHIVE_BYTES:
                    close()
                    writer = None
        if writer is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], ["path", "records"]
            )

    workers_find_package(records.sparkSession)
    return cut(records.mapInArrow(write, "path string, records long"))


def read_archives(archives: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every record of `archives`.

    An archive with a broken record, or with more or fewer records than `archives` says, fails the read.
    With `payloads`, payload holds the bytes of responses.
    """
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if payloads:
        columns, kinds = [*columns, "payload"], [*kinds, pa.binary()]

    def out(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], columns
        )

    def work(batch: pa.RecordBatch):
        store, _ = fs.FileSystem.from_uri(folder)
        for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
            rows, seen, held = [], 0, 0
            with store.open_input_stream(path, compression=None) as source:
                for record in read_records(source):
                    x = parse_record(record)
                    kept = x["payload"] if x["warc-type"] == "response" else None
                    row = (
                        _key(x["warc-record-id"]), x.get("warc-target-uri"), x["length"], x["digest"], x["warc-type"],
                        _key(x.get("warc-refers-to")),
                    )
                    rows.append((*row, kept) if payloads else row)
                    seen += 1
                    held += len(kept or b"") if payloads else 200
                    if held >= 4 << 20:
                        yield out(rows)
                        rows, held = [], 0
            if seen != expected:
                raise WarcError(f"{path} holds {seen} records instead of {expected}")
            if rows:
                yield out(rows)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return arrow_map(archives, work, schema + ", payload binary" * payloads)


def archive_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Writes every row of `pages` (page_id, url, html) to archives in `folder` and reads them back.

    A null html is an empty payload, a null url is about:blank, and a null page_id stays null (it can only be
    a revisit of another page, or a response). An empty table writes no archive and gives no row.
    """
    return read_archives(write_archives(plan_records(pages), folder), folder)
