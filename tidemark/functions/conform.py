"""Raw JSON records to typed columns, as one recursive expression builder.

The payload is read once, with every field that has a rule as a VARIANT, and the
values are converted by the rules of their target types. VARIANT keeps what a typed
JSON read loses: an absent field (SQL NULL) differs from an explicit null, and
the kind of a value is known, so a string that looks like a list stays a string.

A value whose JSON kind is already that of its column is read as such; only the others go
through their text and the lenient rules. The finished row and its first error leave as one
generated row (`inline` of a one-item array), which the optimizer doesn't look through: a filter
above, the check for errors included, never repeats the reading of the record.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import convert
from tidemark.functions.shaping import fail_on

ERRORS = "_errors"
_RECORD, _BROKEN, _PROBLEM = "__record", "__broken", "__problem"
_SUPPORTED = (
    T.StringType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DecimalType, T.BooleanType, T.DateType, T.TimestampType,
)


def conform(
    df: DataFrame,
    payload: str,
    schema: T.StructType,
    *,
    mode: str = "fail",
    paths: Mapping[str, str | Iterable[str]] | None = None,
    computed: Mapping[str, Callable[[Callable[..., Column]], Column]] | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Typed columns of `schema` from the column `payload`: JSON text or VARIANT.

    mode      "fail": a bad value fails the job. "permissive": it becomes NULL and
              `_errors` lists what was wrong in the row.
    paths     field name -> path in the record, for columns flattened out of nested
              objects; the default path is the field name.
    computed  field name -> function that gets `field(*steps)`, the VARIANT at a path, and
              returns the column; for columns that are not a plain field (id arrays), or
              that are landed beside the payload (scope columns).
    keep      input columns to carry along.
    Fields of the record that the schema does not name are dropped.
    """
    if mode not in ("fail", "permissive"):
        raise ValueError(f"mode must be 'fail' or 'permissive', not {mode!r}")
    paths, computed, keep = dict(paths or {}), dict(computed or {}), list(keep)
    taken = [f for f in schema.fields if f.name not in computed]
    steps = {f.name: _steps(paths, f.name) for f in taken}
    for f in taken:
        _check_supported(f.dataType, f.name)

    record = _Record(payload, is_variant=isinstance(df.schema[payload].dataType, T.VariantType))
    for f in taken:
        record.ask(steps[f.name], text=_plain_text(f, steps[f.name]))
    for fn in computed.values():
        fn(record.ask)
    as_text = {f.name for f in taken if record.is_text(steps[f.name])}

    # Separate projections on purpose. Catalyst keeps them apart because each costly
    # column is used more than once above it, so the JSON is read once, and every
    # value is converted once.
    taken_out = [record.field(*steps[f.name]).alias(f"__f{i}") for i, f in enumerate(taken)]
    derived = [fn(record.field).alias(f"__c_{name}") for name, fn in computed.items()]
    parsed = record.parse(df)
    extracted = parsed.select(*keep, record.problem().alias("__bad"), *taken_out, *derived)
    # A plain value's kind, and its text where the kind is not that of its column, are each
    # worked out once in a projection of their own: the lenient rules use them many times.
    leaves = [i for i, f in enumerate(taken) if f.name not in as_text and not _is_nested(f.dataType)]
    raw = [f"__f{i}" for i, f in enumerate(taken) if f.name not in as_text]
    common = [*keep, "__bad", *raw, *[f"__c_{n}" for n in computed]]
    every = [*keep, "__bad", *[f"__f{i}" for i in range(len(taken))], *[f"__c_{n}" for n in computed]]
    kinds = extracted.select(*every, *[F.schema_of_variant(f"__f{i}").alias(f"__k{i}") for i in leaves])
    texts = kinds.select(
        *every,
        *[f"__k{i}" for i in leaves],
        *[
            F.when(~_same(F.col(f"__k{i}"), taken[i].dataType), _text(F.col(f"__f{i}"), F.col(f"__k{i}"))).alias(f"__t{i}")
            for i in leaves
        ],
    )
    built = []
    for i, f in enumerate(taken):
        if f.name in as_text:
            built.append(F.col(f"__f{i}").alias(f"__v{i}"))
            continue
        field = F.col(f"__f{i}")
        if _is_nested(f.dataType):
            value = _pair(field, f.dataType, f.name)
        else:
            value = _leaf(field, f.dataType, F.col(f"__k{i}"), F.col(f"__t{i}"))
        built.append(value.alias(f"__v{i}"))
    converted = texts.select(*common, *built)

    bad = F.col("__bad")
    values: dict[str, Column] = {}
    errors: list[Column] = [bad]
    for i, f in enumerate(taken):
        value, field, error = F.col(f"__v{i}"), F.col(f"__f{i}"), None
        if _is_nested(f.dataType):
            value, error = F.col(f"__v{i}.value").cast(relaxed(f.dataType)), F.col(f"__v{i}.error")
        elif not isinstance(f.dataType, T.StringType):
            error = F.when(value.isNull() & _present(field), _message(field, f.dataType, f.name))
        if not f.nullable:
            missing = F.when(field.isNull(), F.lit(f"required field {f.name} is absent"))
            error = missing if error is None else F.coalesce(missing, error)
        if mode == "fail":
            errors += [] if error is None else [error]
        elif error is not None:
            errors.append(F.when(bad.isNull(), error))
            if _is_nested(f.dataType):
                value = F.when(F.col(f"__v{i}.error").isNull(), value)
        values[f.name] = value
    for name in computed:
        values[name] = F.col(f"__c_{name}").cast(relaxed(schema[name].dataType))
    columns = [values[f.name].alias(f.name) for f in schema.fields]
    wrong = F.coalesce(*errors).alias(_PROBLEM) if mode == "fail" else F.array_compact(F.array(*errors)).alias(ERRORS)
    finished = converted.select(*keep, F.inline(F.array(F.struct(*columns, wrong))))
    return fail_on(finished, F.col(_PROBLEM)).drop(_PROBLEM) if mode == "fail" else finished


def _steps(paths: Mapping, name: str) -> tuple[str, ...]:
    steps = paths.get(name, (name,))
    return tuple(steps.split(".")) if isinstance(steps, str) else tuple(steps)


def _plain_text(field: T.StructField, steps: tuple[str, ...]) -> bool:
    """An optional top-level string: its own text is the value and nothing can be wrong."""
    return len(steps) == 1 and field.nullable and isinstance(field.dataType, T.StringType)


class _Record:
    """How fields are taken out of a payload column.

    JSON text is read once by `from_json`, and only the fields that are asked for: plain
    text fields as text, the others as VARIANT, nested ones out of nested structs. A path
    into a VARIANT is not used, as Spark throws and catches when a step is absent.
    """

    def __init__(self, payload: str, is_variant: bool):
        self.payload, self.from_json = payload, not is_variant
        self.asked: dict[tuple[str, ...], bool] = {}

    def ask(self, *steps, text: bool = False) -> Column:
        """Note a path (as a tuple or as steps). The result stands in for the field."""
        path = steps[0] if isinstance(steps[0], tuple) else steps
        self.asked[path] = text and self.asked.get(path, True)
        return F.lit(None).cast("variant")

    def _has_inner(self, path: tuple[str, ...]) -> bool:
        return any(len(p) > len(path) and p[: len(path)] == path for p in self.asked)

    def is_text(self, path: tuple[str, ...]) -> bool:
        return self.from_json and self.asked[path] and not self._has_inner(path)

    def _whole(self, path: tuple[str, ...]) -> int | None:
        """Length of the shortest prefix that is itself asked for as a whole."""
        return next((n for n in range(1, len(path)) if path[:n] in self.asked), None)

    def field(self, *path: str) -> Column:
        stop = (self._whole(path) or len(path)) if self.from_json else 0
        column = F.col(_RECORD if self.from_json else self.payload)
        for name in path[:stop]:
            column = column.getField(name)
        for name in path[stop:]:
            column = member(column, name)
        return column

    def _schema(self, prefix: tuple[str, ...] = ()) -> T.StructType:
        out = T.StructType()
        for name in dict.fromkeys(p[len(prefix)] for p in self.asked if p[: len(prefix)] == prefix and len(p) > len(prefix)):
            path = (*prefix, name)
            if path in self.asked:
                out = out.add(name, T.StringType() if self.is_text(path) else T.VariantType())
            else:
                out = out.add(name, self._schema(path))
        return out

    def parse(self, df: DataFrame) -> DataFrame:
        if not self.from_json:
            return df
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
        schema = self._schema().add(_BROKEN, T.StringType())
        return df.withColumn(_RECORD, F.from_json(F.col(self.payload), schema, options))

    def problem(self) -> Column:
        """What is wrong with the record as a whole: it must be an object with some field."""
        if not self.from_json:
            size = F.size(F.try_variant_get(F.col(self.payload), "$", "map<string,variant>"))
            return (
                F.when(F.col(self.payload).isNull(), F.lit("record is missing"))
                .when(size.isNull() | (size < 0), F.lit("record is not an object"))
                .when(size == 0, F.lit("record is an empty object"))
            )
        text, broken = F.trim(F.col(self.payload)), F.col(_RECORD).getField(_BROKEN)
        return (
            F.when(text.isNull(), F.lit("record is missing"))
            .when(~text.startswith("{"), F.concat(F.lit("record is not an object: "), text))
            .when(broken.isNotNull(), F.concat(F.lit("record does not parse: "), text))
            .when(text.rlike(r"^\{\s*\}$"), F.lit("record is an empty object"))
        )


def member(v: Column, name: str) -> Column:
    """A member of a VARIANT object; NULL when it is absent or `v` is not an object."""
    shape = T.StructType().add(name, T.VariantType())
    return F.try_variant_get(v, "$", _ddl(shape)).getField(name)


def _ddl(shape: T.StructType) -> str:
    return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:variant" for f in shape.fields) + ">"


def relaxed(dtype: T.DataType) -> T.DataType:
    """The type with every nested value nullable: an explicit null passes even if required."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, relaxed(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(relaxed(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(relaxed(dtype.keyType), relaxed(dtype.valueType))
    return dtype


def _is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def _present(v: Column) -> Column:
    return v.isNotNull() & ~F.is_variant_null(v)


def _text(v: Column, kind: Column | None = None) -> Column:
    """Text of a value. Numbers and containers are written as JSON, which is cheaper than
    the cast of a VARIANT number to string."""
    is_string = (F.schema_of_variant(v) if kind is None else kind) == "STRING"
    return F.when(is_string, F.try_variant_get(v, "$", "string")).when(_present(v), F.to_json(v))


def _message(v: Column, dtype: T.DataType, path: str) -> Column:
    return F.concat(
        F.lit("cannot convert '"),
        F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("?")),
        F.lit("' ("),
        F.coalesce(F.schema_of_variant(v), F.lit("?")),
        F.lit(f") to {dtype.simpleString()} at {path}"),
    )


def _same(kind: Column, dtype: T.DataType) -> Column:
    """Whether a value of this JSON kind is read as the type directly."""
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        return kind == "BIGINT"
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
    if isinstance(dtype, T.BooleanType):
        return kind == "BOOLEAN"
    return F.lit(False)


def _leaf(v: Column, dtype: T.DataType, kind: Column | None = None, text: Column | None = None) -> Column:
    """`kind` and `text` may be given as worked out already: `text` only where `kind` is not the type's own."""
    kind = F.schema_of_variant(v) if kind is None else kind
    lenient = _scalar(_text(v, kind) if text is None else text, kind, dtype)
    if not isinstance(dtype, (T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType)):
        return lenient
    return F.when(_same(kind, dtype), F.try_variant_get(v, "$", dtype.simpleString())).otherwise(lenient)


def _check_supported(dtype: T.DataType, path: str) -> None:
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            _check_supported(f.dataType, f"{path}.{f.name}")
    elif isinstance(dtype, T.ArrayType):
        _check_supported(dtype.elementType, path)
    elif isinstance(dtype, T.MapType):
        _check_supported(dtype.keyType, path)
        _check_supported(dtype.valueType, path)
    elif not isinstance(dtype, _SUPPORTED):
        raise TypeError(f"unsupported type {dtype.simpleString()} at {path}")


def _scalar(text: Column, kind: Column | None, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        return convert.to_long(text, kind, dtype.simpleString())
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return convert.to_double(text, kind, dtype.simpleString())
    if isinstance(dtype, T.DecimalType):
        return convert.to_decimal(text, dtype.simpleString())
    if isinstance(dtype, T.BooleanType):
        return convert.to_boolean(text, kind)
    if isinstance(dtype, T.DateType):
        return convert.to_date_lenient(text, kind)
    return convert.to_timestamp_lenient(text, kind)


# Nested values are converted to a pair of value and first error, so that each part is
# worked out once.


def _of(value: Column, error: Column) -> Column:
    return F.struct(value.alias("value"), error.cast("string").alias("error"))


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, as the item of a one-item array."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _wrong(v: Column, dtype: T.DataType, path: str) -> Column:
    return _of(F.lit(None), _message(v, dtype, path))


def _pair(v: Column, dtype: T.DataType, path: str) -> Column:
    """Pair for a nested value; NULL stands for a NULL value without an error."""
    if isinstance(dtype, T.StringType):
        return _of(_text(v), F.lit(None))
    if isinstance(dtype, T.StructType):
        done = _struct(v, dtype, path)
    elif isinstance(dtype, T.ArrayType):
        done = _array(v, dtype, path)
    elif isinstance(dtype, T.MapType):
        done = _map(v, dtype, path)
    else:
        kept = lambda x: F.when(x.isNotNull(), _of(x, F.lit(None))).otherwise(_wrong(v, dtype, path))
        done = _bind(_leaf(v, dtype), kept)
    return F.when(_present(v), done)


def _struct(v: Column, dtype: T.StructType, path: str) -> Column:
    def member_pair(m: Column, f: T.StructField) -> Column:
        inner, where = m.getField(f.name), f"{path}.{f.name}"
        pair = _pair(inner, f.dataType, where)
        if f.nullable:
            return pair
        absent = _of(F.lit(None), F.lit(f"required field {where} is absent"))
        return F.when(inner.isNotNull(), pair).otherwise(absent)

    def build(m: Column) -> Column:
        pairs = F.struct(*[member_pair(m, f).alias(f.name) for f in dtype.fields])
        failing = [f for f in dtype.fields if not (f.nullable and isinstance(f.dataType, T.StringType))]

        def collect(p: Column) -> Column:
            values = F.struct(*[p[f.name]["value"].alias(f.name) for f in dtype.fields])
            return _of(values, F.coalesce(*[p[f.name]["error"] for f in failing]) if failing else F.lit(None))

        return _bind(pairs, collect)

    # Not an object: the cast gives NULL. An empty object has no member at all.
    nothing = F.to_json(v) == "{}"
    return _bind(
        F.try_variant_get(v, "$", _ddl(dtype)),
        lambda m: F.when(m.isNotNull() & ~nothing, build(m)).otherwise(_wrong(v, dtype, path)),
    )


def _first_error(pairs: Column) -> Column:
    return F.get(F.array_compact(F.transform(pairs, lambda p: p["error"])), F.lit(0))


def _array(v: Column, dtype: T.ArrayType, path: str) -> Column:
    items = F.try_variant_get(v, "$", "array<variant>")
    if dtype.containsNull:  # a single value stands for a list of one
        items = F.coalesce(items, F.array(v))
    if isinstance(dtype.elementType, T.StringType):
        done = F.when(items.isNotNull(), _of(F.transform(items, lambda x: _text(x)), F.lit(None)))
        return done if dtype.containsNull else done.otherwise(_wrong(v, dtype, path))
    pairs = F.transform(items, lambda x: _pair(x, dtype.elementType, f"{path}[]"))

    def collect(ps: Column) -> Column:
        done = F.when(ps.isNotNull(), _of(F.transform(ps, lambda p: p["value"]), _first_error(ps)))
        return done if dtype.containsNull else done.otherwise(_wrong(v, dtype, path))

    return _bind(pairs, collect)


def _map(v: Column, dtype: T.MapType, path: str) -> Column:
    entries = F.try_variant_get(v, "$", "map<string,variant>")
    if isinstance(dtype.keyType, T.StringType) and isinstance(dtype.valueType, T.StringType):
        values = F.transform_values(entries, lambda _, x: _text(x))
        return F.when(entries.isNotNull(), _of(values, F.lit(None))).otherwise(_wrong(v, dtype, path))
    pairs = F.transform_values(entries, lambda _, x: _pair(x, dtype.valueType, f"{path}{{}}"))

    def build(ps: Column) -> Column:
        values = F.transform_values(ps, lambda _, p: p["value"])
        if isinstance(dtype.keyType, T.StringType):
            return F.when(ps.isNotNull(), _of(values, _first_error(F.map_values(ps))))
        key_of = lambda k: _scalar(k, None, dtype.keyType)
        good = ~F.exists(F.map_keys(ps), lambda k: key_of(k).isNull())
        return F.when(good, _of(F.transform_keys(values, lambda k, _: key_of(k)), _first_error(F.map_values(ps))))

    return _bind(pairs, lambda ps: F.coalesce(build(ps), _wrong(v, dtype, path)))


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Already typed columns to a schema: missing ones NULL, extra ones dropped."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(relaxed(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )
