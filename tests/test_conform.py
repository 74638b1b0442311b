"""One row per conversion rule."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.conform import align, conform

UTC = dt.timezone.utc
STAMP = dt.datetime(2024, 1, 2, 3, 4, 5)
ERROR = object()
USER = T.StructType().add("login", T.StringType(), False).add("id", T.LongType())

CASES = [
    (T.LongType(), 12.7, 12),
    (T.LongType(), -12.7, -12),
    (T.LongType(), "12.7", 12),
    (T.LongType(), " 12 ", 12),
    (T.LongType(), 9007199254740993, 9007199254740993),
    (T.LongType(), 1e3, 1000),
    (T.LongType(), True, 1),
    (T.LongType(), False, 0),
    (T.LongType(), "", ERROR),
    (T.LongType(), "x", ERROR),
    (T.LongType(), "1e3", ERROR),
    (T.LongType(), [1], ERROR),
    (T.LongType(), None, None),
    (T.IntegerType(), "7", 7),
    (T.IntegerType(), 3000000000, ERROR),
    (T.DoubleType(), "1.5", 1.5),
    (T.DoubleType(), 2, 2.0),
    (T.DoubleType(), True, 1.0),
    (T.DoubleType(), "1.5f", ERROR),
    (T.DoubleType(), "", ERROR),
    (T.FloatType(), "0.5", 0.5),
    (T.DecimalType(10, 2), "12.34", Decimal("12.34")),
    (T.DecimalType(10, 2), 5, Decimal("5.00")),
    (T.DecimalType(10, 2), "abc", ERROR),
    *[(T.BooleanType(), w, True) for w in ("true", "T", "yes", "Y", "1")],
    *[(T.BooleanType(), w, False) for w in ("FALSE", "f", "no", "N", "0")],
    (T.BooleanType(), True, True),
    (T.BooleanType(), 0, False),
    (T.BooleanType(), 2.5, True),
    (T.BooleanType(), "other", True),
    (T.BooleanType(), "", False),
    (T.BooleanType(), [], False),
    (T.BooleanType(), {"a": 1}, True),
    (T.DateType(), "2024-03-04", dt.date(2024, 3, 4)),
    (T.DateType(), "03/04/2024", dt.date(2024, 3, 4)),
    (T.DateType(), "04-03-2024", dt.date(2024, 3, 4)),
    (T.DateType(), "2024/03/04", dt.date(2024, 3, 4)),
    (T.DateType(), "2024-3-4", dt.date(2024, 3, 4)),
    (T.DateType(), "2024-03-04T23:30:00-05:00", dt.date(2024, 3, 4)),
    (T.DateType(), "2024-02-30", ERROR),
    (T.DateType(), "2024", ERROR),
    (T.DateType(), 20240304, ERROR),
    (T.TimestampType(), "2024-01-02T03:04:05Z", STAMP),
    (T.TimestampType(), "2024-01-02T05:04:05+02:00", STAMP),
    (T.TimestampType(), "2024-01-02T03:04:05", STAMP),
    (T.TimestampType(), "2024-01-02 03:04:05", STAMP),
    (T.TimestampType(), "2024/01/02 03:04:05", STAMP),
    (T.TimestampType(), "2024-01-02T03:04", STAMP.replace(second=0)),
    (T.TimestampType(), "2024-01-02", STAMP.replace(hour=0, minute=0, second=0)),
    (T.TimestampType(), 1704164645, STAMP),
    (T.TimestampType(), 1704164645.5, STAMP.replace(microsecond=500000)),
    (T.TimestampType(), "soon", ERROR),
    (T.StringType(), "[x", "[x"),
    (T.StringType(), 1.5, "1.5"),
    (T.StringType(), True, "true"),
    (T.StringType(), {"a": 1}, '{"a":1}'),
    (T.StringType(), None, None),
    (USER, {"login": "a", "id": "3", "more": 1}, ("a", 3)),
    (USER, {"login": "a"}, ("a", None)),
    (USER, {"login": None, "id": 1}, (None, 1)),
    (USER, {"id": 1}, ERROR),
    (USER, {}, ERROR),
    (USER, [1], ERROR),
    (USER, None, None),
    (T.ArrayType(T.LongType()), [1, "2", None], [1, 2, None]),
    (T.ArrayType(T.LongType()), 7, [7]),
    (T.ArrayType(T.LongType()), [], []),
    (T.ArrayType(T.LongType()), ["x"], ERROR),
    (T.ArrayType(T.LongType(), False), 7, ERROR),
    (T.ArrayType(USER), [{"login": "a", "id": 1}], [("a", 1)]),
    (T.ArrayType(USER), [{"login": "a"}, {}], ERROR),
    (T.ArrayType(T.ArrayType(T.LongType())), [[1], 2], [[1], [2]]),
    (T.MapType(T.StringType(), T.StringType()), {"a": 1, "b": None}, {"a": "1", "b": None}),
    (T.MapType(T.LongType(), T.DoubleType()), {"1": "2.5"}, {1: 2.5}),
    (T.MapType(T.LongType(), T.DoubleType()), {"x": 1}, ERROR),
    (T.MapType(T.StringType(), T.LongType()), {"a": "x"}, ERROR),
    (T.MapType(T.StringType(), T.StringType()), [1], ERROR),
    (T.ArrayType(T.MapType(T.StringType(), T.StringType())), [{"a": 1}], [{"a": "1"}]),
]


def _plain(v):
    if isinstance(v, T.Row):
        return tuple(_plain(x) for x in v)
    if isinstance(v, list):
        return [_plain(x) for x in v]
    return v


def _by_type():
    groups = {}
    for i, (dtype, value, want) in enumerate(CASES):
        groups.setdefault(dtype.simpleString() + str(getattr(dtype, "containsNull", "")), (dtype, []))[1].append(
            (i, value, want)
        )
    return list(groups.values())


@pytest.mark.parametrize("dtype,cases", _by_type(), ids=lambda v: v.simpleString() if isinstance(v, T.DataType) else "")
def test_rules(spark, dtype, cases):
    rows = [(i, json.dumps({"i": i, "v": value})) for i, value, _ in cases]
    schema = T.StructType().add("v", dtype)
    out = conform(spark.createDataFrame(rows, "i int, payload string"), "payload", schema, mode="permissive", keep=["i"])
    got = {r["i"]: r for r in out.collect()}
    for i, value, want in cases:
        row = got[i]
        if want is ERROR:
            assert row["v"] is None and len(row["_errors"]) == 1, (value, row)
        else:
            assert _plain(row["v"]) == want and row["_errors"] == [], (value, row)


def _records(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "payload string")


def test_required_and_absent(spark):
    schema = T.StructType().add("id", T.LongType(), False).add("name", T.StringType())
    df = _records(spark, '{"id":1}', '{"id":null,"name":"x"}', '{"name":"y","extra":[1]}')
    rows = conform(df, "payload", schema, mode="permissive").collect()
    assert [(r["id"], r["name"], len(r["_errors"])) for r in rows] == [(1, None, 0), (None, "x", 0), (None, "y", 1)]
    assert "required field id is absent" in rows[2]["_errors"][0]


@pytest.mark.parametrize("text", ["nonsense", "[1]", "{}", "5", None])
def test_records_that_are_not_objects(spark, text):
    schema = T.StructType().add("a", T.LongType())
    (row,) = conform(_records(spark, text, )if text else _records(spark, None), "payload", schema, mode="permissive").collect()
    assert row["a"] is None and len(row["_errors"]) == 1


def test_fail_mode_names_the_value(spark):
    schema = T.StructType().add("a", T.LongType())
    with pytest.raises(PySparkException, match="cannot convert 'x' .STRING. to bigint at a"):
        conform(_records(spark, '{"a":"x"}'), "payload", schema).collect()


def test_unsupported_type_is_refused(spark):
    with pytest.raises(TypeError):
        conform(_records(spark, "{}"), "payload", T.StructType().add("b", T.BinaryType()))


def test_variant_payload_and_paths(spark):
    df = _records(spark, '{"a":{"b.c":{"d":"4"}}}').select(F.parse_json("payload").alias("payload"))
    schema = T.StructType().add("d", T.LongType())
    assert conform(df, "payload", schema, paths={"d": ("a", "b.c", "d")}).first()["d"] == 4


def test_time_zone_of_the_session_does_not_matter(spark):
    schema = T.StructType().add("t", T.TimestampType())
    df = _records(spark, '{"t":"2024-01-02 03:04:05"}', '{"t":"2024/01/02 03:04:05"}', '{"t":1704164645}')
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = conform(df, "payload", schema).select(F.unix_seconds("t").alias("s")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r["s"] for r in rows} == {1704164645}


def test_align(spark):
    df = spark.createDataFrame([(1, "x")], "id int, extra string")
    schema = T.StructType().add("id", T.LongType()).add("name", T.StringType())
    assert align(df, schema).collect() == [T.Row(id=1, name=None)]


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("mode", ["fail", "permissive"])
def test_payload_is_parsed_once_without_python(spark, mode):
    schema = T.StructType().add("a", T.LongType()).add("b", T.DoubleType()).add("c", USER)
    df = spark.range(5).select(F.to_json(F.struct("id")).alias("payload"))
    done = conform(df, "payload", schema, mode=mode)
    for rows in (done, done.where("a > 1 and c.login = 'x'"), done.groupBy("c").agg(F.sum("a"))):
        assert _optimized(rows).count("from_json(") == 1, _optimized(rows)
        assert "EvalPython" not in _optimized(rows)


@pytest.mark.parametrize(
    "name",
    """conform_events conform_lenient conform_nested conform_permissive unnest_envelope schema_from_catalog github_issues
    github_commits github_reviews github_teams github_branches github_repositories issue_kinds stripe_customers
    stripe_coupons stripe_invoice_items stripe_charges hubspot_contacts hubspot_deals zendesk_tickets
    zendesk_ticket_comments zendesk_organizations""".split(),
)
def test_queries_parse_each_record_once(spark, name):
    from tidemark.plans.queries import QUERIES

    assert _optimized(QUERIES[name](spark, "/root/testdata/sf0.001")).count("from_json(") == 1


def test_an_error_fails_the_job_whatever_is_read(spark):
    df = conform(_records(spark, '{"a":1}', '{"a":"x"}'), "payload", T.StructType().add("a", T.LongType()).add("b", T.StringType()))
    for rows in (df.select("b"), df.groupBy().count()):
        with pytest.raises(PySparkException, match="cannot convert 'x'"):
            rows.collect()
