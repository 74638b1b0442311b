"""Session defaults and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_folder: str | None = None

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.scheduler.mode": "FAIR",
    # Above this size the JVM does not compile a method; Spark then splits the code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Without the call site of every expression, wide definitions are built twice as fast.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "tidemark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run, under the folder that the cluster names.

    Only a local session without that setting gets a temporary folder.
    """
    global _local_folder
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        if _local_folder is None:
            _local_folder = tempfile.mkdtemp(prefix="tidemark-")
        root = _local_folder
    return f"{root.rstrip('/')}/tidemark/{purpose}-{uuid.uuid4().hex[:12]}"


def put_line(spark: SparkSession, file: str, line: str) -> None:
    """A file with one line of text: a small record that the driver has anyway, so no Spark job is run for it.

    The file gets its name when it is whole, so that a reader sees all of it or nothing.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(file)
    fresh = hadoop.Path(path.getParent(), f"_{uuid.uuid4().hex}")  # Spark's readers pass over such names
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(fresh, True)
    try:
        out.write(bytearray(f"{line}\n", "utf-8"))
    finally:
        out.close()
    if not files.rename(fresh, path):  # not all file systems replace a file
        files.delete(path, False)
        if not files.rename(fresh, path):
            raise OSError(f"{file} can't be written")
