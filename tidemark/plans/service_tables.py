"""Queries over whole table definitions: every column of a service's table, through the flow of its mode.

The records are derived from a given table, one object per row. Every third object also comes in an older version, which
the flow must replace. Of five objects one has null in its optional columns, one has numbers and booleans as text, one
lacks the optional columns; so each column is read from every form in which a service may send it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import CDC, SNAPSHOT, TableDef
from tidemark.operators.changes import apply_changes
from tidemark.operators.snapshot import apply_snapshot
from tidemark.sources.catalog import CATALOG
from tidemark.sources.catalog.crm import object_table
from tidemark.sources.landed import scan_table
from tidemark.sources.records import table_rows

#: Per service the given table that its objects come from, that table's key, and the tables read.
SERVICES = {
    "github": ("part", "p_partkey", "pull_requests comments users organizations assignees collaborators"),
    "hubspot": ("customer", "c_custkey", "companies tickets calls emails meetings tasks notes deal_split"),
    "stripe": (
        "orders",
        "o_orderkey",
        "payment_intents subscriptions invoices products prices refunds disputes payment_methods balance_transactions "
        "payouts plans events",
    ),
    "zendesk": ("events", "event_id", "articles brands groups topics users"),
}
_PROPERTIES = [("name", "string"), ("score", "number"), ("active", "bool"), ("level", "enumeration")]
_NULLS, _TEXTS, _LACKS = 0, 1, 2


def definition(service: str, name: str) -> TableDef:
    return object_table(name, _PROPERTIES) if service == "hubspot" else CATALOG[service][name]


def _always(table: TableDef, field: T.StructField) -> bool:
    return not field.nullable or field.name in table.keys or field.name == table.cursor


# -- records ----------------------------------------------------------------------------


def _landed(name: str, dtype: T.DataType, place: int, version: int, as_text: bool) -> Column:
    """The value of a field in the record of object `key`."""
    key = F.col("key")
    if isinstance(dtype, T.StructType):
        return F.struct(*[_landed(f.name, f.dataType, i, version, as_text).alias(f.name) for i, f in enumerate(dtype)])
    if isinstance(dtype, T.MapType):
        return F.struct(_landed(name, dtype.valueType, place, version, as_text).alias("k"))
    if isinstance(dtype, T.ArrayType):
        return F.array(_landed(name, dtype.elementType, place, version, as_text))
    if isinstance(dtype, T.LongType):
        number = key * 10 + version + place
        return number.cast("string") if as_text else number
    if isinstance(dtype, T.BooleanType):
        even = F.pmod(key + version + place, F.lit(2)) == 0
        return F.when(even, "yes").otherwise("no") if as_text else even
    return F.concat(F.lit(f"{name}-"), key, F.lit(f"-{version}"))


def _value(table: TableDef, field: T.StructField, place: int, version: int, as_text: bool) -> Column:
    if field.name in table.id_arrays:
        ids = F.array(F.struct(F.col("key").alias("id")), F.struct((F.col("key") + 1).alias("id")))
        return F.struct(ids.alias("results"))
    if field.name in table.json_text:
        return F.struct((F.col("key") + version).alias("k"))
    if field.name in table.falsy_text:
        return F.pmod("key", F.lit(4)) / 4
    return _landed(field.name, field.dataType, place, 0 if field.name in table.keys else version, as_text)


def _nested(leaves: list[tuple[tuple[str, ...], Column]]) -> Column:
    """A struct with each value at its path."""
    members: dict[str, list] = {}
    for path, value in leaves:
        members.setdefault(path[0], []).append((path[1:], value))
    return F.struct(*[(of[0][1] if of[0][0] == () else _nested(of)).alias(name) for name, of in members.items()])


def landed_records(objects: DataFrame, table: TableDef, version: int) -> DataFrame:
    """(payload, scope columns) of each row's object, from a frame with the column `key`."""

    def record(as_text: bool, skip_nulls: bool) -> Column:
        leaves = []
        for place, field in enumerate(table.schema):
            if field.name in table.scope:
                continue
            path = table.id_arrays.get(field.name) or table.paths.get(field.name) or (field.name,)
            value = _value(table, field, place, version, as_text)
            if not _always(table, field):
                value = F.when(~F.pmod("key", F.lit(5)).isin(_NULLS, _LACKS), value)
            leaves.append((tuple(path.split(".")) if isinstance(path, str) else tuple(path), value))
        return F.to_json(_nested(leaves), {"ignoreNullFields": str(skip_nulls).lower()})

    turn = F.pmod("key", F.lit(5))
    payload = F.when(turn == _TEXTS, record(True, False)).when(turn == _LACKS, record(False, True)).otherwise(record(False, False))
    scope = [_landed(c, table.schema[c].dataType, 0, 0, False).alias(landed) for c, landed in table.scope.items()]
    return objects.select(payload.alias("payload"), *scope)


def current_rows(objects: DataFrame, table: TableDef) -> DataFrame:
    """The table after both versions of its objects, nested columns as JSON text."""
    older = landed_records(objects.where("key % 3 = 0"), table, 1)
    newer = landed_records(objects, table, 2)
    if table.ingestion_mode == SNAPSHOT:
        rows = apply_snapshot(table_rows(older, table), table_rows(newer, table), list(table.keys))
    elif table.ingestion_mode == CDC:
        rows = apply_changes(table_rows(newer.union(older), table), list(table.keys), table.cursor)
    else:
        raise ValueError(f"{table.name}: objects come in versions, which {table.ingestion_mode} doesn't know")
    nested = (T.StructType, T.MapType, T.ArrayType)
    return rows.select(
        *[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in table.schema]
    )


# -- SQL --------------------------------------------------------------------------------


def _sql_scalar(name: str, dtype: T.DataType, place: int, version: int) -> str:
    if isinstance(dtype, T.LongType):
        return f"(key * 10 + {version + place})"
    if isinstance(dtype, T.BooleanType):
        return f"((key + {version + place}) % 2 = 0)"
    return f"('{name}-' || key || '-{version}')"


def _sql_json(name: str, dtype: T.DataType, place: int, version: int) -> str:
    if isinstance(dtype, T.StructType):
        members = [f"""'"{f.name}":' || {_sql_json(f.name, f.dataType, i, version)}""" for i, f in enumerate(dtype)]
        return "'{' || " + reduce(lambda a, b: f"{a} || ',' || {b}", members) + " || '}'"
    if isinstance(dtype, T.MapType):
        return f"""'{{"k":' || {_sql_json(name, dtype.valueType, place, version)} || '}}'"""
    if isinstance(dtype, T.ArrayType):
        return f"'[' || {_sql_json(name, dtype.elementType, place, version)} || ']'"
    value = _sql_scalar(name, dtype, place, version)
    return f"""'"' || {value} || '"'""" if isinstance(dtype, T.StringType) else f"{value}::varchar"


def table_sql(service: str, table: TableDef) -> str:
    """What `current_rows` must give: the newer version of each object."""
    source, key, _ = SERVICES[service]
    columns = []
    for place, field in enumerate(table.schema):
        version = 0 if field.name in table.keys or field.name in table.scope else 2
        if field.name in table.scope:
            place = 0
        otherwise = "null"
        if field.name in table.id_arrays:
            value, otherwise = """'["' || key || '","' || (key + 1) || '"]'""", "'[]'"
        elif field.name in table.json_text:
            value = f"""'{{"k":' || (key + {version}) || '}}'"""
        elif field.name in table.falsy_text:
            value = "case key % 4 when 1 then '0.25' when 2 then '0.5' when 3 then '0.75' end"
        elif isinstance(field.dataType, (T.StructType, T.MapType, T.ArrayType)):
            value = _sql_json(field.name, field.dataType, place, version)
        else:
            value = _sql_scalar(field.name, field.dataType, place, version)
        if field.name in table.defaults:
            otherwise = str(table.defaults[field.name]).lower()
        if not _always(table, field) and field.name not in table.scope:
            value = f"case when key % 5 in ({_NULLS}, {_LACKS}) then {otherwise} else {value} end"
        columns.append(f'{value} as "{field.name}"')
    return f"with o as (select {key}::bigint as key from {source})\nselect " + ",\n  ".join(columns) + "\nfrom o"


def register(query: Callable) -> None:
    """One query per table, by `query(name, sql)`."""
    for service, (source, key, names) in SERVICES.items():
        for name in names.split():
            table = definition(service, name)

            def run(spark: SparkSession, sf: str, table=table, source=source, key=key) -> DataFrame:
                objects = scan_table(spark, f"{sf}/{source}.parquet").select(F.col(key).cast("long").alias("key"))
                return current_rows(objects, table)

            query(f"{service}_{name}", table_sql(service, table))(run)
