"""A target table kept in plain parquet folders, in buckets by a hash of the key.

Open-source Spark has no MERGE on plain files. Here a write reads and replaces only the buckets that hold its keys; the
files of all other buckets stay as they are and belong to the new version too:

    <root>/data/<write>/__bucket=<b>/   rows of a bucket, as one write left them
    <root>/manifest/version=<n>/        one small file per version: the folders of every bucket, the columns, the writes taken in

Many batches can be worked out together (`prepare`) and are then committed one by one: a version's bucket has parts then, which are
folders with rows of several batches and the number up to which they count. Reads give the latest rows of these; the next write
of the bucket, or the last batch of a run, makes plain rows of them.

A version counts once its manifest is there; what a lost job left behind is referred to by none. Files never change, so a
version and the difference between two of them read the same whenever they are asked for, as long as they are kept: the newest
`keep_versions` are, and with each write the folders that only older ones refer to are removed. One writer per table.

A batch is known by its flow (for a stream, the id of the query that its checkpoint holds) and its number, a snapshot by its
run. Batches may add columns, leave some out (their rows have NULL there), and widen integers and floats; any other change of
a type is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import DELETED, START, apply_changes, refresh_history
from tidemark.operators.latest import latest_per_key, orderable
from tidemark.operators.snapshot import apply_snapshot, open_history, snapshot_diff
from tidemark.workspace import put_line

BUCKET = "__bucket"
#: Parts of a bucket, or of its change log, before they are written as one.
LOG_PARTS = 16
#: The batch of a row, in folders that hold several.
NUMBER = "__batch"

_WIDER = {
    T.ByteType(): [T.ShortType(), T.IntegerType(), T.LongType()],
    T.ShortType(): [T.IntegerType(), T.LongType()],
    T.IntegerType(): [T.LongType()],
    T.FloatType(): [T.DoubleType()],
}


def merged_schema(stored: T.StructType, batch: T.StructType) -> T.StructType:
    """Columns of both, in the order in which they came; the wider of two types, if one of them widens the other."""
    fields = {f.name: f.dataType for f in stored.fields}
    for f in batch.fields:
        have = fields.setdefault(f.name, f.dataType)
        if f.dataType in _WIDER.get(have, []):
            fields[f.name] = f.dataType
        elif have != f.dataType and have not in _WIDER.get(f.dataType, []):
            raise ValueError(f"column {f.name} is {have.simpleString()} and can't become {f.dataType.simpleString()}")
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def _with_number(ranges: list[list[int]], number: int) -> list[list[int]]:
    """Sorted ranges of numbers with one more in them."""
    out: list[list[int]] = []
    for low, high in sorted([*ranges, [number, number]]):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(high, out[-1][1])
        else:
            out.append([low, high])
    return out


class TargetTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str] | str,
        sequence_by: Sequence[str] | str = (),
        *,
        scd_type: int | str = 1,
        apply_as_deletes: str | None = None,
        buckets: int = 16,
        keep_versions: int = 10,
        flow: str = "main",
    ):
        """`buckets` counts when the table is first written; choose it so that a bucket is a few files of usual size."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.sequence = [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)
        self.scd = str(scd_type).upper().removeprefix("SCD_TYPE_")
        self.deletes = apply_as_deletes
        self.buckets = buckets
        self.keep_versions = max(1, keep_versions)
        self.flow = flow

    # -- versions --------------------------------------------------------------

    def _live(self) -> list[dict]:
        """The manifests that are kept, the newest last: `keep_versions` and those that a lost job didn't remove."""
        try:
            rows = self.spark.read.schema("manifest string, version long").json(f"{self.root}/manifest").collect()
        except AnalysisException:
            return []  # nothing written yet
        return [json.loads(r["manifest"]) for r in sorted(rows, key=lambda r: r["version"])]

    def versions(self) -> list[int]:
        return [m["version"] for m in self._live()]

    def _at(self, version: int | None) -> dict:
        live = self._live()
        if not live:
            raise ValueError(f"nothing committed in {self.root}")
        found = [m for m in live if version is None or m["version"] == version]
        if not found:
            raise ValueError(f"version {version} of {self.root} isn't kept; there are {[m['version'] for m in live]}")
        return found[-1]

    @staticmethod
    def _taken_in(manifest: dict | None, flow: str, number: int) -> bool:
        return manifest is not None and any(low <= number <= high for low, high in manifest["writes"].get(flow, []))

    def _commit(self, live: list[dict], manifest: dict) -> None:
        put_line(self.spark, f"{self.root}/manifest/version={manifest['version']}/manifest.json", json.dumps({"manifest": json.dumps(manifest)}))
        self._forget([*live, manifest])

    def _forget(self, live: list[dict], keep: int | None = None) -> None:
        """Removes the versions before the newest ones, and what only they refer to."""
        keep = keep or self.keep_versions
        old, kept = live[:-keep], live[-keep:]
        used = {p for m in kept for p in self._paths(m)}
        for m in old:
            for path in {*self._paths(m)} - used:
                self._remove(path)
            self._remove(f"{self.root}/manifest/version={m['version']}")

    @staticmethod
    def _paths(manifest: dict) -> Iterable[str]:
        for entry in manifest["buckets"].values():
            yield from entry["rows"]
            yield from entry["log"]
            yield from (path for path, _ in entry.get("parts", []))

    def _remove(self, path: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def compact(self) -> None:
        """Forgets all versions but the newest."""
        self._forget(self._live(), keep=1)

    # -- writing ---------------------------------------------------------------

    def upsert(self, changes: DataFrame, batch_id: int, flow: str | None = None) -> bool:
        """Apply a batch of changes once, also if it is sent again under the same flow and number: False for a batch that is there.

        Only the buckets of the batch's keys are read and written. For type 2 each keeps its change log, because a late change can
        bring back a row that was folded away before; the histories of the batch's keys alone are worked out again.
        """
        flow = flow or self.flow
        if not self.keys or not self.sequence:
            raise ValueError("an upsert needs key and sequence columns")
        live = self._live()
        last = live[-1] if live else None
        if self._taken_in(last, flow, batch_id):
            return False
        history = self.scd == "2"
        if history:
            rows = self._flagged(changes)
            rows = rows.distinct() if all(orderable(f.dataType) for f in rows.schema.fields) else rows
        else:
            rows = apply_changes(changes, self.keys, self.sequence, apply_as_deletes=self.deletes, keep_tombstones=True)
        staged, touched = self._stage(rows, last)
        schema = rows.schema if last is None else merged_schema(T.StructType.fromJson(last["log_schema"]), rows.schema)
        batch = self._scan(staged.values(), schema)
        old = {b: e for b, e in (last["buckets"] if last else {}).items() if b in touched}
        if history:
            logs = {b: [*old.get(b, {"log": []})["log"], staged[b]] for b in touched}
            log = self._scan([p for parts in logs.values() for p in parts], schema)
            if old:
                before = self._scan([p for e in old.values() for p in e["rows"]], self._history_schema(schema))
                done = refresh_history(before, log, batch, self.keys, self.sequence)
            else:
                done = apply_changes(log, self.keys, self.sequence, scd_type=2)
            long = [b for b in touched if len(logs[b]) > LOG_PARTS]
            if long:
                whole = self._write(self._scan([p for b in long for p in logs[b]], schema), last)
                logs |= {b: [whole[b]] for b in long}
        else:
            logs = {}
            stored = self._unmerged(old.values(), schema) if old else None
            done = batch if stored is None else latest_per_key(stored.unionByName(batch), self.keys, self.sequence)
        written = staged if not history and not old else self._write(done, last)
        entries = {
            b: {"rows": [written[b]] if b in written else [], "log": logs.get(b, []), "digest": None} for b in touched
        }
        if not history and old:
            for path in staged.values():
                self._remove(path)
        self._commit(live, self._next(last, "batch", flow, batch_id, schema, done.schema, entries))
        return True

    def prepare(self, changes: DataFrame, number: str, flow: str | None = None, *, last: int | None = None) -> Callable[[int], None]:
        """Work out many batches at once, which the column `number` tells apart; gives a function that commits one by its number.

        For type 1. Each batch is reduced like one of `upsert`, and the rows of all are written once, by bucket. The commits come in the
        order of the numbers and are versions like any others; with that of `last`, buckets that have parts become plain rows.
        """
        flow = flow or self.flow
        if not self.keys or not self.sequence or self.scd == "2":
            raise ValueError("batches are prepared for type 1, with key and sequence columns")
        live = self._live()
        rows = apply_changes(changes, [number, *self.keys], self.sequence, apply_as_deletes=self.deletes, keep_tombstones=True)
        rows = rows.withColumn(number, F.col(f"`{number}`").cast("bigint")).withColumnRenamed(number, NUMBER)
        staged, _ = self._stage(rows, live[-1] if live else None)
        own = T.StructType([f for f in rows.schema.fields if f.name != NUMBER])
        touched = self._touched(staged)

        def commit(batch_id: int) -> None:
            before = live[-1] if live else None
            if self._taken_in(before, flow, batch_id):
                return
            schema = own if before is None else merged_schema(T.StructType.fromJson(before["log_schema"]), own)
            have = before["buckets"] if before else {}
            entries = {}
            for b in touched.get(batch_id, ()):
                old = have.get(b, {"rows": []})
                parts = [p for p in old.get("parts", []) if p[0] != staged[b]]
                entries[b] = {"rows": old["rows"], "log": [], "digest": None, "parts": [*parts, [staged[b], batch_id]]}
            parted = {b: e for b, e in {**have, **entries}.items() if e.get("parts")}
            whole = {b: e for b, e in parted.items() if batch_id == last or len(e["parts"]) > LOG_PARTS}
            if whole:
                written = self._write(latest_per_key(self._unmerged(whole.values(), schema), self.keys, self.sequence), before)
                entries |= {b: {"rows": [written[b]], "log": [], "digest": None} for b in whole}
            manifest = self._next(before, "batch", flow, batch_id, schema, schema, entries)
            self._commit(live, manifest)
            live[:] = [*live, manifest][-self.keep_versions :]

        return commit

    def _touched(self, staged: dict[str, str]) -> dict[int, Collection[str]]:
        """The buckets that each of the prepared batches has rows in."""
        if not staged:
            return {}
        folder = next(iter(staged.values())).rsplit("/", 1)[0]
        rows = self.spark.read.schema(T.StructType().add(NUMBER, T.LongType()).add(BUCKET, T.IntegerType())).parquet(folder)
        found = rows.groupBy(NUMBER).agg(F.collect_set(F.col(BUCKET).cast("string")).alias("buckets")).collect()
        return {r[NUMBER]: r["buckets"] for r in found}

    def replace(self, snapshot: DataFrame, run_id: int, *, complete: bool = True) -> None:
        """Take in a snapshot once per run: current rows (type 1), or history with `run_id` as version (type 2).

        The manifest has a digest of each bucket's rows that doesn't depend on their order. Buckets whose digest and number of rows
        are those of the last complete snapshot are neither read nor written.
        """
        live = self._live()
        last = live[-1] if live else None
        if self._taken_in(last, f"snapshot {self.flow}", run_id):
            return
        history, version = self.scd == "2", F.lit(run_id).cast("bigint")
        staged, touched = self._stage(snapshot, last)
        schema = snapshot.schema if last is None else merged_schema(T.StructType.fromJson(last["log_schema"]), snapshot.schema)
        digests = self._digests(staged, schema) if complete else {}
        have = last["buckets"] if last else {}
        compared = {*touched, *have} if complete else touched
        differing = {b for b in compared if b not in have or digests.get(b) is None or digests[b] != have[b]["digest"]}
        new = self._scan([staged[b] for b in differing if b in staged], schema)
        old = self._merged([have[b] for b in differing if b in have], self._history_schema(schema, version) if history else schema)
        if history:
            done = open_history(new, version) if last is None else apply_snapshot(old, new, self.keys, complete=complete, scd_type=2, version=version)
        else:
            done = new if complete or last is None else apply_snapshot(old, new, self.keys, complete=False)
        plain = not history and (complete or last is None)
        written = {b: staged[b] for b in differing if b in staged} if plain else self._write(done, last)
        for b, path in staged.items():
            if not (plain and b in differing):
                self._remove(path)
        entries = {b: {"rows": [written[b]] if b in written else [], "log": [], "digest": digests.get(b)} for b in differing}
        self._commit(live, self._next(last, "snapshot", f"snapshot {self.flow}", run_id, schema, done.schema, entries))

    def _next(self, last: dict | None, kind: str, flow: str, number: int, log_schema, schema, entries: dict) -> dict:
        writes = dict(last["writes"]) if last else {}
        writes[flow] = _with_number(writes.get(flow, []), number)
        buckets = {b: e for b, e in {**(last["buckets"] if last else {}), **entries}.items() if e["rows"] or e["log"] or e.get("parts")}
        return {
            "version": last["version"] + 1 if last else 0, "kind": kind, "writes": writes, "n_buckets": self._count(last),
            "log_schema": json.loads(log_schema.json()), "schema": json.loads(schema.json()), "buckets": buckets,
        }

    def _count(self, last: dict | None) -> int:
        return last["n_buckets"] if last else self.buckets

    def _stage(self, rows: DataFrame, last: dict | None) -> tuple[dict[str, str], set[str]]:
        """The rows written by bucket, so that they are worked out once; the folder of each bucket that has some."""
        staged = self._write(rows, last)
        return staged, set(staged)

    def _write(self, rows: DataFrame, last: dict | None) -> dict[str, str]:
        bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self._count(last))).cast("int")
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        # Rows of a bucket come together; adaptive execution splits a large one into several files and merges small ones.
        rows.withColumn(BUCKET, bucket).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        names = [s.getPath().getName() for s in path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)]
        return {n.removeprefix(f"{BUCKET}="): f"{folder}/{n}" for n in names if n.startswith(f"{BUCKET}=")}

    def _scan(self, paths: Iterable[str], schema: T.StructType) -> DataFrame:
        paths = list(paths)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _unmerged(self, entries: Iterable[dict], schema: T.StructType) -> DataFrame:
        """The rows of some buckets as their folders have them: with parts, one of a key from each batch that has it."""
        entries = list(entries)
        rows = self._scan([p for e in entries for p in e["rows"]], schema)
        folders: dict[str, list[list]] = {}
        for part in (p for e in entries for p in e.get("parts", [])):
            folders.setdefault(part[0].rsplit("/", 1)[0], []).append(part)
        numbered = T.StructType([*schema.fields, T.StructField(NUMBER, T.LongType())])
        for parts in folders.values():
            # A bucket that the last of these batches leaves alone has no rows of it, so that one bound holds for all.
            upto = max(n for _, n in parts)
            rows = rows.unionByName(self._scan([p for p, _ in parts], numbered).where(F.col(NUMBER) <= upto).drop(NUMBER))
        return rows

    def _merged(self, entries: Iterable[dict], schema: T.StructType) -> DataFrame:
        """The rows of some buckets: a scan, but where buckets have parts the latest row of each key."""
        entries = list(entries)
        parted = [e for e in entries if e.get("parts")]
        if not parted:
            return self._unmerged(entries, schema)
        rows = latest_per_key(self._unmerged(parted, schema), self.keys, self.sequence)
        plain = [e for e in entries if not e.get("parts")]
        return rows.unionByName(self._unmerged(plain, schema)) if plain else rows

    def _history_schema(self, schema: T.StructType, start=None) -> T.StructType:
        kind = T.LongType() if start is not None else schema[self.sequence[0]].dataType
        kept = [f for f in schema.fields if f.name != DELETED]
        return T.StructType([*kept, T.StructField(START, kind), T.StructField("__end_at", kind)])

    def _digests(self, staged: dict[str, str], schema: T.StructType) -> dict[str, list]:
        """Number of rows and two sums of row hashes for each bucket; none if a column can't be hashed."""
        if not staged or not all(orderable(f.dataType) for f in schema.fields):
            return {}
        columns = [F.col(f"`{c}`") for c in schema.fieldNames()]
        # A null adds nothing to a hash, so that which columns are null is hashed too.
        nulls = F.concat(*[c.isNull().cast("string") for c in columns])
        total = lambda *more: F.sum(F.xxhash64(*more, nulls, *columns).cast("decimal(38,0)")).cast("string")
        folder = next(iter(staged.values())).rsplit("/", 1)[0]
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(folder)
        found = rows.groupBy(BUCKET).agg(F.count("*").alias("n"), total().alias("a"), total(F.lit(1)).alias("b")).collect()
        return {str(r[BUCKET]): [r["n"], r["a"], r["b"]] for r in found}

    # -- reading ---------------------------------------------------------------

    def log(self, version: int | None = None) -> DataFrame:
        """Stored rows as written: for type 2 every change, for type 1 the latest rows with tombstones."""
        m = self._at(version)
        history = self.scd == "2" and self.sequence
        schema = T.StructType.fromJson(m["log_schema" if history else "schema"])
        if history:
            return self._scan([p for e in m["buckets"].values() for p in e["log"]], schema)
        return self._merged(m["buckets"].values(), schema)

    def read(self, version: int | None = None) -> DataFrame:
        """Current rows, or the history of a type 2 target: a scan of the version's files."""
        return self._rows(self._at(version))

    def _rows(self, manifest: dict, buckets: Iterable[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
        entries = [e for b, e in manifest["buckets"].items() if buckets is None or b in buckets]
        rows = self._merged(entries, schema or T.StructType.fromJson(manifest["schema"]))
        if DELETED in rows.columns:
            rows = rows.where(~F.coalesce(F.col(DELETED), F.lit(False))).drop(DELETED)
        return rows

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """Rows inserted, updated and deleted between two versions, with their `change_type`; the same whenever asked.

        Only buckets whose folders differ are read. A row of a type 2 target is known by its keys and its start.
        """
        first, then = self._at(since), self._at(until)
        differing = {b for b in {*first["buckets"], *then["buckets"]} if first["buckets"].get(b) != then["buckets"].get(b)}
        schema = T.StructType.fromJson(then["schema"])
        keys = [*self.keys, START] if self.scd == "2" else self.keys
        return snapshot_diff(self._rows(first, differing, schema), self._rows(then, differing, schema), keys)

    # -- helpers ---------------------------------------------------------------

    def _flagged(self, changes: DataFrame) -> DataFrame:
        if self.deletes is None:
            return changes
        return changes.withColumn(DELETED, F.coalesce(F.expr(self.deletes), F.lit(False)))
