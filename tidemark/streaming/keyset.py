"""Reading a landed table in batches of a number of rows, by the pair of cursor and key.

Spark's file source caps a micro-batch by files and bytes. Here a batch is the next `rows` rows in the order of (cursor, keys), so
that a service's page limits hold, and a batch may end inside a group of equal cursors without losing a row.

The end of a batch is written down before its rows are taken in, and again when that is done: a batch that was cut short is
finished with the end it had. The marks also tell where the next run begins. It first looks back: rows that came late, but no further
behind the mark than `lookback` seconds, are taken in as a batch of their own, which the limit doesn't count.

The rows after the mark are read once per run and kept beside the marks, sorted by cursor and key, so that a row has a position and
a batch reads its own span of them. The ends of up to AHEAD batches are found in one pass. A target that can work out many batches
together (`prepare`) does so before the first of them is taken in; each still has its own marks and its own commit.

Rows with a NULL cursor belong to the first batch ever; later ones of that kind are not seen.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from itertools import accumulate
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.convert import iso_minus_seconds
from tidemark.operators.latest import orderable
from tidemark.operators.paging import batch_ends
from tidemark.streaming.flows import observe_mark
from tidemark.workspace import put_line

#: Batches whose ends are found, and that are prepared, together.
AHEAD = 1024
AT, NUMBER = "__position", "__batch"
_MARK = "n long, done boolean, mark string, rows long, seen string"


class Marks:
    """The ends of a flow's batches, one small file each; those before the last two are removed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def last(self) -> list[dict]:
        """The newest two marks, the newest first; a mark that is done stands before the same one as it was planned."""
        try:
            rows = self.spark.read.schema(_MARK).json(self.folder).select(*_names()).collect()
        except AnalysisException:
            return []  # nothing written yet
        newest: dict[int, dict] = {}
        for r in sorted(rows, key=lambda r: (r["n"], r["done"])):
            newest[r["n"]] = r.asDict()
        return [newest[n] for n in sorted(newest, reverse=True)][:2]

    def write(self, n: int, mark: str, *, done: bool, rows: int | None = None, seen: str | None = None) -> None:
        row = {k: v for k, v in zip(_names(), (n, done, mark, rows, seen), strict=True) if v is not None}
        put_line(self.spark, f"{self.folder}/batch={n}/{'done' if done else 'planned'}.json", json.dumps(row))
        if done and n > 2:
            jvm = self.spark._jvm
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/batch={n - 3}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _names() -> list[str]:
    return [c.split(" ")[0] for c in _MARK.split(", ")]


def drain(
    spark: SparkSession,
    read: Callable[[object], DataFrame],
    cursor: str,
    keys: Sequence[str],
    rows: int,
    apply: Callable[[DataFrame, int], bool | None],
    folder: str,
    *,
    lookback: int | None = None,
    prepare: Callable[[DataFrame, str, int | None], Callable[[int], None]] | None = None,
) -> int:
    """Takes in everything after the last mark in batches of `rows` rows; returns the number of batches.

    `read(since)` gives the rows with a cursor of `since` or more (None: all), and `apply(rows, n)` takes in batch `n` once, or says False if it has it already. Without
    keys the other columns order the rows of one cursor; rows that are equal in all come in one batch.

    `prepare(rows, number, last)` works out the batches that the column `number` tells apart and gives a function that takes in one
    of them, to be called in their order; `last` is the last one of the run, if it is among them.
    """
    marks = Marks(spark, folder)
    kinds = read(None).schema
    order = [cursor, *[k for k in keys if k != cursor]]
    if not keys:
        order += [f.name for f in kinds.fields if f.name != cursor and orderable(f.dataType)]
    place = F.struct(*[F.col(f"`{c}`") for c in order])
    shape = "struct<" + ",".join(f"`{c}`:{kinds[c].dataType.simpleString()}" for c in order) + ">"
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}

    def pair(mark: str) -> Column:
        return F.from_json(F.lit(mark), shape, options)

    def since(mark: str | None, seconds: int = 0):
        """The mark's cursor as a value of its type, moved back by some seconds."""
        if mark is None:
            return None
        value = pair(mark).getField(cursor)
        if seconds:
            kind = kinds[cursor].dataType.typeName()
            if kind == "string":
                value = iso_minus_seconds(value, seconds)
            elif kind.startswith("timestamp"):
                value = value - F.make_dt_interval(secs=F.lit(seconds))
            else:
                value = value - F.lit(seconds).cast(kinds[cursor].dataType)
        return spark.range(1).select(value.alias("since")).first()["since"]

    def between(after: str | None, end: str) -> DataFrame:
        found = read(since(after)).where(place <= pair(end))
        return found if after is None else found.where(place > pair(after))

    def take_in(found: DataFrame, n: int, end: str) -> None:
        watched, seen = observe_mark(found, cursor)
        if apply(watched, n) is False:  # its rows were not read, so that there is nothing to wait for
            marks.write(n, end, done=True)
            return
        got = seen.get
        marks.write(n, end, done=True, rows=got["rows"], seen=str(got["high_water_mark"]))

    known = marks.last()
    n, end, batches = (known[0]["n"], known[0]["mark"], 0) if known else (-1, None, 0)
    if known and not known[0]["done"]:
        take_in(between(known[1]["mark"] if len(known) > 1 else None, end), n, end)
        batches += 1
    elif known and lookback:
        n += 1
        take_in(read(since(end, lookback)).where(place <= pair(end)), n, end)
        batches += 1
    found = read(since(end))
    pending = Sorted(found if end is None else found.where(place > pair(end)), order, f"{folder.rstrip('/')}-pending/{uuid.uuid4().hex}")
    at, ahead = 0, AHEAD
    while at < pending.size:
        ends = _next_ends(pending, order, rows, at, ahead, options, pair)
        ahead = min(AHEAD, 2 * len(ends))  # where many batches end inside a place, few are looked at in vain
        commit = None
        if prepare is not None:
            commit = _prepared(pending, cursor, rows, at, n + 1, ends, prepare)
        for upto, mark, top in ends:
            n, end = n + 1, mark
            marks.write(n, end, done=False)
            if commit is None:
                take_in(pending.between(at, upto).drop(AT), n, end)
            else:
                commit(n)
                marks.write(n, end, done=True, rows=upto - at, seen=str(top))
            at = upto
            batches += 1
    return batches


def _next_ends(pending: Sorted, order: Sequence[str], rows: int, at: int, ahead: int, options: dict, pair: Callable[[str], Column]) -> list[tuple[int, str, object]]:
    """Of the next batches after position `at`: the position of their last row, its place as a mark, and its cursor.

    Where a batch of `rows` rows would part rows of one place it goes on to the last of them, and is the last that is given.
    """
    place = F.struct(*[F.col(f"`{c}`") for c in order])
    beyond = min(at + rows * ahead, pending.size)
    last = min(beyond + 1, pending.size)
    found = batch_ends(pending.between(at, last), order, AT, rows, after=at, last=last).where(F.col("upto") <= beyond)
    ends = []
    for r in found.select("upto", F.to_json("end", options).alias("mark"), F.col("end").getField(order[0]).alias("top"), "parted").orderBy("upto").collect():
        upto, mark = r["upto"], json.dumps(json.loads(r["mark"]))
        if r["parted"]:
            upto = pending.between(upto - 1, pending.size).where(place <= pair(mark)).agg(F.max(AT)).first()[0]
        ends.append((upto, mark, r["top"]))
        if r["parted"]:
            break
    return ends


def _prepared(pending: Sorted, cursor: str, rows: int, at: int, n: int, ends: list, prepare: Callable) -> Callable[[int], None]:
    """The function that takes in one of the batches with these ends, of which `n` is the first."""
    upto, last = ends[-1][0], n + len(ends) - 1
    number = F.least(F.floor((F.col(AT) - at - 1) / F.lit(rows)) + n, F.lit(last)).cast("bigint")
    watched, seen = observe_mark(pending.between(at, upto).withColumn(NUMBER, number).drop(AT), cursor)
    commit = prepare(watched, NUMBER, last if upto == pending.size else None)
    if (got := seen.get["rows"]) != upto - at:
        raise RuntimeError(f"{got} rows were prepared of {upto - at} that stand in {pending.path}")
    return commit


class Sorted:
    """Rows written once, sorted by `order` across files, and read back by their position, from 1."""

    def __init__(self, rows: DataFrame, order: Sequence[str], path: str):
        self.spark, self.schema, self.path = rows.sparkSession, rows.schema, path
        columns = [F.col(f"`{c}`") for c in order]
        rows.repartitionByRange(*columns).sortWithinPartitions(*columns).write.parquet(path)
        written = self.spark.read.schema(self.schema).parquet(path)
        found = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(F.struct(*columns)).alias("first"), F.count("*").alias("n"))
        files = found.orderBy("first").select("file", "n").collect()
        self.files = [r["file"] for r in files]
        self.starts = [0, *accumulate(r["n"] for r in files)]
        self.size = self.starts[-1]

    def between(self, after: int, upto: int) -> DataFrame:
        """The rows after one position up to another, with their positions; only files that have some of them are opened."""
        low, high = bisect_right(self.starts, after) - 1, bisect_right(self.starts, upto - 1)
        starts = F.create_map(*[F.lit(x) for f, s in zip(self.files[low:high], self.starts[low:high], strict=True) for x in (f, s)])
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in self.files[low:high]])
        at = (starts[F.col("_metadata.file_name")] + F.col("_metadata.row_index") + 1).cast("bigint")
        return rows.withColumn(AT, at).where((F.col(AT) > after) & (F.col(AT) <= upto))
