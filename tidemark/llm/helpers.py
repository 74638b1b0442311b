"""What the operators of this subpackage share: cutting lineage, Arrow maps, and reading a table's columns."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.workspace import shared_folder

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def cut(df: DataFrame) -> DataFrame:
    """The frame, worked out once and kept in the cluster's checkpoint folder, where it outlives any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def keep(df: DataFrame) -> DataFrame:
    """Like `cut`, as a Parquet table in the shared folder: smaller, and small parts are read together. Rows may come in another order."""
    folder = shared_folder(df.sparkSession, "kept")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def workers_find_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver found it."""
    environment = spark.sparkContext.environment
    if _ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), _ROOT]))


def give_back_memory() -> None:
    """Hands what Arrow and the C library hold free back to the machine, which else stays with the worker for its later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """`work` for every Arrow batch of every partition."""
    workers_find_package(df.sparkSession)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)
        give_back_memory()

    return df.mapInArrow(run, schema)


@contextmanager
def no_cycle_search():
    """For code that makes very many objects and no cycles among them: Python doesn't look for cycles meanwhile."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def free_names(taken: Iterable[str], *names: str) -> list[str]:
    """Each name, with underscores in front until none of `taken` is like it (Spark doesn't tell upper from lower case)."""
    taken, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
