"""Column helpers for nested and semi-structured records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def fail_on(df: DataFrame, problem: Column) -> DataFrame:
    """The rows as they are; the first one with a problem (a text, else null) fails the job.

    The check is a filter, so that it also runs if no column of the row is used. rand() keeps the optimizer from
    trying it on a row of nulls or moving it below a join.
    """
    checked = F.when(problem.isNotNull() & (F.rand(0) >= 0), F.raise_error(problem).cast("boolean")).otherwise(True)
    return df.where(checked)


def json_text(value: Column | str, dtype: T.DataType | None = None) -> Column:
    """JSON text of a nested value; an empty, zero, false or null one is NULL.

    Text input is taken as JSON already. A struct, array or map is written with
    its null fields kept.
    """
    text = _col(value)
    if dtype is not None and not isinstance(dtype, T.StringType):
        text = F.to_json(text, {"ignoreNullFields": "false"})
    return F.when(~F.trim(text).isin("", "{}", "[]", "null", "false", "0", "0.0"), text)


def falsy_to_null(value: Column | str) -> Column:
    """Number or its text as text; zero, blank and null are NULL."""
    text = _col(value).cast("string")
    number = text.try_cast("double")
    return F.when((text != "") & (number.isNull() | (number != 0)), text)


def with_default(value: Column | str, default) -> Column:
    return F.coalesce(_col(value), F.lit(default))


def flatten(root: str, fields: Mapping[str, str] | list[str], prefix: str | None = None) -> list[Column]:
    """`root.x` -> column `<prefix>x`; a null parent gives null columns.

    `fields` is a list of names, or a mapping of dotted path -> column name.
    """
    prefix = f"{root}_" if prefix is None else prefix
    if isinstance(fields, Mapping):
        return [F.col(f"{root}.{path}").alias(name) for path, name in fields.items()]
    return [F.col(f"{root}.{f}").alias(prefix + f.replace(".", "_")) for f in fields]


def flatten_map(map_column: str, names_and_types: Mapping[str, str], prefix: str = "properties_") -> list[Column]:
    """Named entries of a map as typed columns `<prefix><name>`."""
    return [
        F.col(map_column).getItem(name).try_cast(type_name).alias(prefix + name)
        for name, type_name in names_and_types.items()
    ]


def id_array(value: Column | str) -> Column:
    """Ids of an association, given as a VARIANT (`parse_json` of its text).

    Accepts `{"results": [{"id": ..}]}` or a list of objects and plain values. A
    missing association is an empty array, an object without an id gives "".
    """
    v = _col(value)
    items = F.coalesce(
        F.try_variant_get(F.try_variant_get(v, "$", "struct<results:variant>").getField("results"), "$", "array<variant>"),
        F.try_variant_get(v, "$", "array<variant>"),
    )

    def one(x: Column) -> Column:
        as_object = F.try_variant_get(x, "$", "struct<id:variant>")
        inner = as_object.getField("id")
        from_object = F.when(inner.isNull(), F.lit("")).otherwise(F.try_variant_get(inner, "$", "string"))
        return F.when(as_object.isNotNull(), from_object).otherwise(F.try_variant_get(x, "$", "string"))

    return F.coalesce(F.transform(items, one), F.array().cast("array<string>"))


def merge_records(left: Column | str, right: Column | str) -> Column:
    """Two map columns as one; where both have a key the right one wins."""
    left, right = _col(left), _col(right)
    kept = F.map_filter(left, lambda k, _: ~F.array_contains(F.map_keys(right), k))
    return F.when(right.isNull(), left).when(left.isNull(), right).otherwise(F.map_concat(kept, right))


def next_link(link_header: Column | str) -> Column:
    """URL of the `rel="next"` part of a Link header, or NULL."""
    url = F.regexp_extract(_col(link_header), r'<([^>]*)>[^,]*rel="next"', 1)
    return F.when(url != "", url)


def next_token(body: Column | str) -> Column:
    """`paging.next.after` of a response body; NULL on the last page."""
    return F.get_json_object(_col(body), "$.paging.next.after")


def page_number(url: Column | str) -> Column:
    """Number in the `page=` query parameter of a URL, or NULL."""
    digits = F.regexp_extract(_col(url), r"[?&]page=(\d+)", 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def clamp(value: Column | str, low: int, high: int, default: int) -> Column:
    """Integer option text kept inside `low..high`; unreadable text gives the default."""
    number = F.coalesce(_col(value).try_cast("bigint"), F.lit(default).cast("bigint"))
    return F.least(F.greatest(number, F.lit(low).cast("bigint")), F.lit(high).cast("bigint"))
