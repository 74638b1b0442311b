"""From landed records to the rows of a table: conform plus the shape rules of its definition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.conform import conform, member
from tidemark.functions.shaping import falsy_to_null, id_array, json_text, merge_records
from tidemark.model import TableDef


def table_rows(
    df: DataFrame, table: TableDef, payload: str = "payload", *, mode: str = "fail", keep=()
) -> DataFrame:
    """Typed rows of `table` from a frame with one record per row in `payload`."""

    def scope_value(column: str):
        return lambda _: F.col(column)

    def ids(path: str):
        return lambda field: id_array(field(*path.split(".")))

    computed = {c: ids(path) for c, path in table.id_arrays.items()}
    # Scope columns are landed beside the record; without them the record must have them.
    computed |= {c: scope_value(landed) for c, landed in table.scope.items() if landed in df.columns}
    rows = conform(df, payload, table.schema, mode=mode, paths=table.paths, computed=computed, keep=keep)
    rules: dict[str, Column] = {c: json_text(c) for c in table.json_text}
    rules |= {c: falsy_to_null(c) for c in table.falsy_text}
    rules |= {c: F.coalesce(F.col(f"`{c}`"), F.lit(v)) for c, v in table.defaults.items()}
    return rows.withColumns(rules) if rules else rows


def comment_records(
    df: DataFrame, payload: str = "payload", *, event_type: str = "Comment", keep=()
) -> DataFrame:
    """Comments out of landed ticket events, as VARIANT records in `payload`.

    The fields of the child win over those of the event; the event's own id stays as
    `event_id`. Works on streams.
    """
    carried = ("id", "ticket_id", "created_at", "updated_at")
    event_schema = T.StructType()
    for name in (*carried, "child_events"):
        event_schema = event_schema.add(name, T.VariantType())
    event, child = F.col("__event"), F.col("__child")
    children = F.try_variant_get(event.getField("child_events"), "$", "array<variant>")
    wanted = F.filter(children, lambda c: F.try_variant_get(member(c, "event_type"), "$", "string") == event_type)
    parsed = df.select(*keep, F.from_json(F.col(payload), event_schema).alias("__event"))
    exploded = parsed.select(*keep, "__event", F.explode(wanted).alias("__child"))
    pairs = [("event_id", "id"), *[(name, name) for name in carried]]
    parent = F.create_map(*[x for name, source in pairs for x in (F.lit(name), event.getField(source))])
    record = merge_records(parent, F.try_variant_get(child, "$", "map<string,variant>"))
    return exploded.select(*keep, F.to_variant_object(record).alias(payload))
