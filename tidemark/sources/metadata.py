"""Table listing, table metadata and schema discovery as DataFrame work."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import CDC, TableDef
from tidemark.sources.catalog.crm import ASSOCIATIONS, STANDARD_OBJECT_TYPES, UNLISTED, object_table

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("tableName", T.StringType(), False),
        T.StructField("primary_key", T.ArrayType(T.StringType())),
        T.StructField("cursor_field", T.StringType()),
        T.StructField("ingestion_type", T.StringType()),
    ]
)


def definitions_frame(spark: SparkSession, tables: Iterable[TableDef]) -> DataFrame:
    """One metadata row per definition."""
    rows = [(t.name, list(t.keys), t.cursor, t.mode) for t in tables]
    return spark.createDataFrame(rows, METADATA_SCHEMA)


def table_metadata(requests: DataFrame, names: str, definitions: DataFrame) -> DataFrame:
    """Metadata of the tables named in comma lists, one row per name.

    Names are trimmed and blank ones dropped; a missing mode is cdc. A name without a
    definition fails the job.
    """
    wanted = requests.select(F.explode(F.split(F.col(names), ",")).alias("__name")).select(
        F.trim("__name").alias("__name")
    )
    wanted = wanted.where(F.col("__name") != "")
    known = definitions.withColumn("__known", F.lit(True))
    joined = wanted.join(known, wanted["__name"] == known["tableName"], "left")
    unknown = F.raise_error(F.concat(F.lit("unknown table "), F.col("__name")))
    return joined.select(
        F.when(F.col("__known").isNull(), unknown).otherwise(F.col("__name")).alias("tableName"),
        "primary_key",
        "cursor_field",
        F.coalesce("ingestion_type", F.lit(CDC)).alias("ingestion_type"),
    )


def discover_tables(catalogue: DataFrame, standard: Iterable[str] | DataFrame | None = None) -> DataFrame:
    """Standard table names and those of the custom objects in an object catalogue.

    The catalogue has `objectTypeId` and `name`; a custom object is one whose type id is
    not a standard one and whose name is not empty.
    """
    custom = catalogue.where(
        ~F.coalesce(F.col("objectTypeId"), F.lit("")).isin(STANDARD_OBJECT_TYPES) & (F.length("name") > 0)
    ).select(F.lower("name").alias("table_name"))
    if isinstance(standard, DataFrame):
        return standard.select("table_name").union(custom)
    names = list(standard) if standard is not None else [n for n in ASSOCIATIONS if n not in UNLISTED]
    listed = catalogue.sparkSession.createDataFrame([(n,) for n in names], "table_name string")
    return listed.union(custom)


def schema_from_catalog(
    catalogue: DataFrame, table: str, types: Mapping[str, T.DataType] | None = None
) -> TableDef:
    """Definition of a table from its property catalogue (`name`, `type`).

    The catalogue is a list of columns, so it is small by nature; it is read to the
    driver because a schema has to be known before a plan can be built.
    """
    properties = [(r["name"], r["type"]) for r in catalogue.select("name", "type").collect()]
    return object_table(table, properties, types)
