"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and reads all that the one before it kept. All but the last return the columns of
`documents`: low-quality documents go, one document of each group of near-duplicates stays, documents that hold an item
of `benchmark` go, secrets in the texts are replaced. The last packs what is left into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.helpers import cut, free_names, shared_folder, table
from tidemark.llm.near_duplicates import near_duplicates
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality import score_quality, train_quality
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.secrets import constructed_findings, redact, train_secrets


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches 0.5, as labels.quality marks them."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = score_quality(docs, train_quality(docs, labels))
    return scored.filter(F.col(scored.columns[-1]) >= 0.5).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that is linked at a similarity of 80 percent: that with the smallest id, a null id after all others.

    Each row has a number of its own, so that rows of one id, of none, or equal in all columns are judged like any others; of
    equal rows the one that is read first stays. Rows without words are linked with nothing and stay.
    """
    row, component = free_names(docs.columns, "_row", "_component")
    folder = shared_folder(spark, "numbered")
    docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(folder)  # read twice below, with the same numbers
    numbered = spark.read.parquet(folder)
    found = near_duplicates(numbered, id_column=row, percent=80).select(F.col("id").alias(row), F.col("component_id").alias(component))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", F.col(row).alias("row"))
    members = cut(found.join(numbered.select(row, place.alias("place")), row))
    first = members.groupBy(component).agg(F.min("place").alias("first"))
    dropped = members.join(first, component).filter(F.col(row) != F.col("first.row")).select(row)
    return numbered.join(dropped, row, "left_anti").select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 80 percent of the five-word shingles of no benchmark item; each row by its own text, null ids too."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced."""
    return redact(docs, train_secrets(constructed_findings(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 tokens."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secrets", hide_secrets),
    ("packing", pack_sequences),
]

#: Forests and support vectors have no form in SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
