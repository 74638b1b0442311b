"""Structured Streaming flows: upsert into a target, append, drain and stop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.append import dedupe_append
from tidemark.operators.ordered import null_safe
from tidemark.plans.target import TargetTable

BATCH, KEYS = "append_batch", "_keys"


def upsert_stream(
    rows: DataFrame, target: TargetTable, checkpoint: str, *, name: str | None = None, once: bool = True
) -> StreamingQuery:
    """Start a query that applies every micro-batch of changes to the target.

    `once` drains what is there and stops (all of it, in as many micro-batches as the
    source caps ask for). A micro-batch that is sent again after a failure is written once.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        # The id of the query lives in its checkpoint: a new checkpoint starts a new flow at batch 0.
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        target.upsert(batch, batch_id, query_id)

    writer = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _start(writer, name, once)


def append_flow(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    *,
    keys: Sequence[str] | None = None,
    name: str | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Start a query that appends rows to a parquet folder, exactly once per input row.

    With `keys` a row that the source sends again is dropped, however late, and no late row is lost: each micro-batch is compared
    with the stored keys. It opens only the files that may hold its keys: batches are written in the order of the first key, and
    `_keys` beside them has the lowest and highest first key of every file. No state grows with the table.
    The folder then has a column `append_batch`, the query and number of the micro-batch that wrote a row.
    """
    if keys:
        return _start(rows.writeStream.foreachBatch(_append_once(path, list(keys))).option("checkpointLocation", checkpoint), name, once)
    writer = (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, name, once)


def _append_once(path: str, keys: list[str]):
    def apply(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, path, keys, f"{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}")

    return apply


def append_batch(batch: DataFrame, path: str, keys: Sequence[str], own: str) -> None:
    """Append a batch known as `own`: each key once, and none that is stored; without keys, all rows. Sent again, it replaces what it wrote."""
    spark = batch.sparkSession
    if not keys:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={own}")
        return
    # Copies within the batch go first; what is left is kept, since it is needed twice.
    fresh = dedupe_append(batch, keys).persist(StorageLevel.DISK_ONLY)
    try:
        stored = stored_with(spark, path, fresh, keys[0], own)
        if stored is not None:
            known = stored.select(*[F.col(f"`{k}`").alias(f"__k_{k}") for k in keys])
            new = fresh.join(known, null_safe(fresh, known, keys, "__k_"), "left_anti")
        else:
            new = fresh
        new.sort(keys[0]).write.mode("overwrite").parquet(f"{path}/{BATCH}={own}")
    finally:
        fresh.unpersist()
    key = F.col(f"`{keys[0]}`")
    found = spark.read.schema(batch.schema).parquet(f"{path}/{BATCH}={own}").groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count_if(key.isNull()).alias("nulls")
    )
    found.coalesce(1).write.mode("overwrite").parquet(f"{path}/{KEYS}/{BATCH}={own}")


def stored_with(spark: SparkSession, path: str, batch: DataFrame, key: str, own: str | None = None) -> DataFrame | None:
    """The stored rows that may have a first key of the batch: those of the files whose span of keys meets the batch's.

    Batches without an index (an older layout, or a lost job's) are read as a whole. None if nothing is stored. `own` is left out.
    """
    folders = {n for n in _names(spark, path) if n.startswith(f"{BATCH}=")} - {f"{BATCH}={own}"}
    if not folders:
        return None
    indexed = {n for n in _names(spark, f"{path}/{KEYS}") if n.startswith(f"{BATCH}=")} & folders
    paths = [f"{path}/{n}" for n in sorted(folders - indexed)]
    span = batch.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count_if(F.col(f"`{key}`").isNull()).alias("nulls")).first()
    kind = batch.schema[key].dataType
    low, high = (F.lit(span[c]).cast(kind) for c in ("low", "high"))
    if indexed:
        spans = spark.read.parquet(f"{path}/{KEYS}").where(F.col(BATCH).isin([n.removeprefix(f"{BATCH}=") for n in indexed]))
        meets = ((F.col("low") <= high) & (F.col("high") >= low)) | ((F.col("nulls") > 0) & F.lit(span["nulls"] > 0))
        files = spans.where(meets)
        paths += [f"{path}/{BATCH}={r[BATCH]}/{r['file']}" for r in files.select(BATCH, "file").collect()]
    if not paths:
        return None
    rows = spark.read.option("mergeSchema", "true").parquet(*paths)
    inside = F.col(f"`{key}`").between(low, high)  # reaches the row groups
    return rows.where(inside | F.col(f"`{key}`").isNull() if span["nulls"] else inside)


def _names(spark: SparkSession, path: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []


def _start(writer, name: str | None, once: bool) -> StreamingQuery:
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(availableNow=True) if once else writer).start()


def observe_mark(rows: DataFrame, cursor: str) -> tuple[DataFrame, Observation]:
    """Rows unchanged, with their highest cursor and count observed while they are written."""
    seen = Observation("mark")
    return rows.observe(seen, F.max(cursor).alias("high_water_mark"), F.count(F.lit(1)).alias("rows")), seen
