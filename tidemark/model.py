"""What a table is: schema, keys, cursor, mode, and how its record is shaped."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CDC, SNAPSHOT, APPEND = "cdc", "snapshot", "append"
MODES = (CDC, SNAPSHOT, APPEND)


@dataclass(frozen=True)
class TableDef:
    """One table of a source.

    paths       column -> path in the record (dotted text or steps), for flattened columns
    json_text   columns holding JSON text; empty values are NULL
    falsy_text  number columns kept as text; zero is NULL
    defaults    column -> value for a missing field
    scope       column -> column landed beside the payload
    id_arrays   column -> path of an association in the record
    envelope    key of the record array in a response body (None: the body is the array)
    events      the landed records are events whose comment children are the rows
    required    scope options that a read needs
    one_of      scope options of which a read needs exactly one
    archived    whether archived rows are left out unless the option `archived` is true
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    cursor: str | None = None
    mode: str | None = None
    paths: Mapping[str, str | tuple[str, ...]] = field(default_factory=dict)
    json_text: tuple[str, ...] = ()
    falsy_text: tuple[str, ...] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)
    scope: Mapping[str, str] = field(default_factory=dict)
    id_arrays: Mapping[str, str] = field(default_factory=dict)
    envelope: str | None = None
    events: bool = False
    required: tuple[str, ...] = ()
    one_of: tuple[str, ...] = ()
    archived: bool = False

    @property
    def ingestion_mode(self) -> str:
        return self.mode or CDC

    def check(self) -> None:
        """Fail early on a definition that no flow can run."""
        if self.ingestion_mode not in MODES:
            raise ValueError(f"{self.name}: unknown mode {self.mode!r}")
        if self.ingestion_mode in (CDC, SNAPSHOT) and not self.keys:
            raise ValueError(f"{self.name}: mode {self.ingestion_mode} needs key columns")
        if self.ingestion_mode == CDC and not self.cursor:
            raise ValueError(f"{self.name}: mode cdc needs a cursor column")
        known = set(self.schema.fieldNames())
        unknown = [c for c in (*self.keys, *([self.cursor] if self.cursor else [])) if c not in known]
        if unknown:
            raise ValueError(f"{self.name}: not in the schema: {', '.join(unknown)}")


@runtime_checkable
class TableSource(Protocol):
    """A user source. `read` and `read_stream` give lazy DataFrames, never rows."""

    def list_tables(self) -> list[str]: ...

    def table(self, name: str, options: Mapping[str, str]) -> TableDef: ...

    def read(
        self, spark: SparkSession, name: str, since, options: Mapping[str, str]
    ) -> DataFrame: ...

    def read_stream(self, spark: SparkSession, name: str, options: Mapping[str, str]) -> DataFrame: ...


def text_options(options: Mapping[str, object] | None) -> dict[str, str]:
    """Options as text: lists and mappings become JSON, everything else its text."""
    if options is None:
        return {}
    if not isinstance(options, Mapping):
        raise ValueError("table options must be a mapping")
    return {
        str(k): json.dumps(v) if isinstance(v, (dict, list)) else str(v) for k, v in options.items()
    }


def flag(options: Mapping[str, object], name: str, default: bool) -> bool:
    """A yes or no option, in any case: true, yes, 1 or false, no, 0."""
    value = str(options.get(name, default)).strip().lower()
    if value not in ("true", "yes", "1", "false", "no", "0"):
        raise ValueError(f"option {name} is neither true nor false: {options[name]!r}")
    return value in ("true", "yes", "1")


def requested_tables(spec: Mapping[str, object]) -> dict[str, dict[str, str]]:
    """Table name -> options out of `{"connection_name", "objects": [{"table": {..}}]}`."""
    if not isinstance(spec, Mapping):
        raise ValueError("the spec must be a mapping")
    _only(spec, {"connection_name", "objects"}, "spec")
    connection = spec.get("connection_name")
    if not isinstance(connection, str) or not connection.strip():
        raise ValueError("the spec needs a non-empty connection_name")
    objects = spec.get("objects")
    if not isinstance(objects, Sequence) or isinstance(objects, str) or not objects:
        raise ValueError("the spec needs a non-empty list of objects")
    tables: dict[str, dict[str, str]] = {}
    for entry in objects:
        table = entry.get("table") if isinstance(entry, Mapping) else None
        if not isinstance(table, Mapping):
            raise ValueError("every object needs a table")
        _only(entry, {"table"}, "object")
        _only(table, {"source_table", "table_configuration"}, "table")
        name = table.get("source_table")
        if not isinstance(name, str):
            raise ValueError("every table needs a source_table name")
        if name in tables:
            raise ValueError(f"table {name!r} is listed twice")
        tables[name] = text_options(table.get("table_configuration"))
    return tables


def _only(mapping: Mapping, allowed: set[str], what: str) -> None:
    extra = set(mapping) - allowed
    if extra:
        raise ValueError(f"unknown keys in {what}: {', '.join(sorted(map(str, extra)))}")
