"""Short notation for table schemas.

`"id:long! name tags:[string] via:map user:user"` is a list of `name:type` words.
The type defaults to string; `!` marks a required field, `[..]` an array, `map` a
map of string to string. Other names are taken from `named`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "map": T.MapType(T.StringType(), T.StringType()),
}


def fields(text: str, named: Mapping[str, T.DataType] | None = None) -> T.StructType:
    known = {**_TYPES, **(named or {})}

    def type_of(name: str) -> T.DataType:
        return T.ArrayType(type_of(name[1:-1])) if name.startswith("[") else known[name]

    struct = T.StructType()
    for word in text.split():
        name, _, type_name = word.partition(":")
        required = type_name.endswith("!") or name.endswith("!")
        struct = struct.add(name.rstrip("!"), type_of(type_name.rstrip("!") or "string"), not required)
    return struct
