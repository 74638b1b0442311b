"""Operators against brute force, order independence, and skew."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import shaping
from tidemark.operators import contract, cursor, filters, joins, paging, shape
from tidemark.operators.append import dedupe_append
from tidemark.operators.changes import END, START, apply_changes
from tidemark.operators.latest import latest_per_key
from tidemark.operators.ordered import positions
from tidemark.operators.snapshot import apply_snapshot, open_history, snapshot_diff

CHANGES = "k string, seq int, v string, gone boolean"


def _changes(seed: int, n: int = 300) -> list[tuple]:
    """A third of all rows belong to one key; sequences and rows repeat."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        key = "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", "c", None])
        rows.append((key, rnd.randint(0, n // 2), rnd.choice("xyz"), rnd.random() < 0.1))
    return rows + rows[: n // 5]


def _current(rows: list[tuple]) -> dict:
    best: dict = {}
    for k, s, v, g in rows:
        best[k] = max(best.get(k, (-1,)), (s, v, g))
    return best


def _history(rows: list[tuple], deletes: bool) -> set:
    out = set()
    for key in {r[0] for r in rows}:
        per_seq: dict = {}
        for _, s, v, g in (r for r in rows if r[0] == key):
            flag = g if deletes else False
            per_seq[s] = max(per_seq.get(s, (False, "", False)), (flag, v, g))
        runs = []
        for s, (flag, v, g) in sorted(per_seq.items()):
            if not runs or runs[-1][1:] != (flag, v, g):
                runs.append((s, flag, v, g))
        for i, (s, flag, v, g) in enumerate(runs):
            if not flag:
                out.add((key, v, s, runs[i + 1][0] if i + 1 < len(runs) else None))
    return out


@pytest.mark.parametrize("ranked", [True, False])
def test_latest_is_the_same_in_any_order(spark, ranked):
    rows = _changes(1)
    want = {(k, *v) for k, v in _current(rows).items()}
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, CHANGES).repartition(seed + 1)
        assert {tuple(r) for r in latest_per_key(df, "k", "seq", ranked=ranked).collect()} == want


@pytest.mark.parametrize("pieces", [None, 1, 40])
@pytest.mark.parametrize("deletes", [False, True])
def test_history_matches_brute_force(spark, pieces, deletes):
    rows = _changes(3)
    df = spark.createDataFrame(rows, CHANGES)
    spans = apply_changes(
        df, "k", "seq", scd_type=2, pieces=pieces, apply_as_deletes="gone" if deletes else None
    )
    got = [(r["k"], r["v"], r[START], r[END]) for r in spans.collect()]
    assert len(got) == len(set(got)) and set(got) == _history(rows, deletes)


@pytest.mark.parametrize("pieces", [None, 1, 60])
def test_positions_match_brute_force(spark, pieces):
    rnd = random.Random(5)
    rows = [("hot" if i % 3 else rnd.choice("abcdef"), i) for i in rnd.sample(range(5000), 600)]
    df = spark.createDataFrame(rows, "g string, i int").repartition(5)
    by_group: dict = {}
    for g, i in sorted(rows, key=lambda r: r[1]):
        by_group.setdefault(g, []).append(i)
    want = {(g, i, n + 1) for g, items in by_group.items() for n, i in enumerate(items)}
    assert {tuple(r) for r in positions(df, ["g"], ["i"], pieces=pieces).collect()} == want
    everything = {i: n + 1 for n, i in enumerate(sorted(i for _, i in rows))}
    got = positions(df, [], ["i"], pieces=pieces).collect()
    assert {r["i"]: r["position"] for r in got} == everything and len(got) == len(rows)


def test_hot_groups_are_spread_over_tasks(spark):
    """With half of all rows in one group, no window task gets that group whole."""
    from tidemark.operators.ordered import in_chunks

    df = spark.range(30_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("g"), "id")
    chunks = in_chunks(df, ["g"], ["id"], pieces=40)
    sizes = [r["count"] for r in chunks.groupBy("g", "__chunk").count().collect() if r["g"] == 0]
    assert sum(sizes) == 15_000 and len(sizes) > 15 and max(sizes) < 1_500
    got = positions(df, ["g"], ["id"], pieces=40).agg(F.max("position"), F.count_distinct("g", "position")).first()
    assert tuple(got) == (15_000, 30_000)


def test_positions_of_ties_and_odd_values(spark):
    """Rows that are equal in order, nulls, NaN and values that JSON rounds are numbered once each."""
    rows = [(None if i % 3 else "a", [None, float("nan"), 0.1, 1e300][i % 4], i % 5) for i in range(400)] + [("a", 0.1, 1)] * 50
    df = spark.createDataFrame(rows, "g string, x double, y int").withColumn("m", F.create_map(F.lit("k"), "y"))
    for pieces in (1, 32):
        got = positions(df, ["g"], ["x"], pieces=pieces)
        assert got.columns == [*df.columns, "position"]
        for g in (None, "a"):
            group = sorted(r["position"] for r in got.collect() if r["g"] == g)
            assert group == list(range(1, len(group) + 1))
    assert positions(df.limit(0), ["g"], ["x"]).count() == 0


def test_apply_changes_rejects_bad_arguments(spark):
    df = spark.createDataFrame([("a", 1, "x", False)], CHANGES)
    for keys, seq, kind in [([], "seq", 1), ("k", [], 1), ("k", "seq", 3)]:
        with pytest.raises(ValueError):
            apply_changes(df, keys, seq, scd_type=kind)


def test_stale_change_and_tombstone(spark):
    stored = spark.createDataFrame([("a", 5, "new", False), ("b", 5, "b", False)], CHANGES)
    batch = spark.createDataFrame([("a", 3, "old", False), ("b", 6, "b", True)], CHANGES)
    kept = apply_changes(batch, "k", "seq", stored=stored, apply_as_deletes="gone", keep_tombstones=True)
    late = spark.createDataFrame([("b", 4, "late", False)], CHANGES)
    out = apply_changes(late, "k", "seq", stored=kept, apply_as_deletes="gone").collect()
    assert [(r["k"], r["v"]) for r in out] == [("a", "new")]


def test_map_columns_are_carried(spark):
    df = spark.createDataFrame([("a", 1, {"x": "1"}), ("a", 2, {"x": "2"})], "k string, s int, m map<string,string>")
    for ranked in (True, False):
        assert latest_per_key(df, "k", "s", ranked=ranked).first()["m"] == {"x": "2"}


SNAP = "a string, b int, v string"


def test_snapshot_with_composite_null_keys(spark):
    old = spark.createDataFrame([("x", 1, "p"), (None, 1, "q"), ("z", None, "r"), ("w", 1, None)], SNAP)
    new = spark.createDataFrame([("x", 1, "P"), (None, 1, "q"), ("y", 2, "s"), ("w", 1, None)], SNAP)
    diff = {(r["a"], r["b"], r["v"], r["change_type"]) for r in snapshot_diff(old, new, ["a", "b"]).collect()}
    assert diff == {("x", 1, "P", "update"), ("z", None, "r", "delete"), ("y", 2, "s", "insert")}
    history = apply_snapshot(open_history(old, 1), new, ["a", "b"], scd_type=2, version=2)
    got = {(r["a"], r["b"], r["v"], r[START], r[END]) for r in history.collect()}
    assert got == {
        ("x", 1, "p", 1, 2), ("x", 1, "P", 2, None), (None, 1, "q", 1, None),
        ("z", None, "r", 1, 2), ("y", 2, "s", 2, None), ("w", 1, None, 1, None),
    }
    again = apply_snapshot(history, new, ["a", "b"], scd_type=2, version=3)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in history.collect()}


def test_incomplete_snapshot_keeps_unseen_rows(spark):
    old = spark.createDataFrame([("x", 1, "p"), ("y", 1, "q")], SNAP)
    new = spark.createDataFrame([("x", 1, "P")], SNAP)
    rows = apply_snapshot(old, new, ["a", "b"], complete=False).collect()
    assert {tuple(r) for r in rows} == {("x", 1, "P"), ("y", 1, "q")}
    history = apply_snapshot(open_history(old, 1), new, ["a", "b"], complete=False, scd_type=2, version=2)
    assert {(r["a"], r[END]) for r in history.collect()} == {("x", 2), ("x", None), ("y", None)}


def test_dedupe_append_batch(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "id int, v string")
    stored = spark.createDataFrame([(2, "b")], "id int, v string")
    assert {r["id"] for r in dedupe_append(rows, "id", stored=stored).collect()} == {1, None}


def test_cursor_rules(spark):
    df = spark.createDataFrame(
        [("2024-01-01T00:10:00Z", 5), (None, None), ("2024-01-01T00:05:00Z", 3)], "at string, n int"
    )
    assert cursor.next_cursor(df, "at").first()[0] == "2024-01-01T00:05:00Z"
    assert cursor.next_cursor(df, "at", lookback_seconds=0).first()[0] == "2024-01-01T00:10:00Z"
    assert cursor.high_water_mark(df, "n", previous=F.lit(9)).first()[0] == 9
    odd = spark.createDataFrame([("page-7",)], "at string")
    assert cursor.next_cursor(odd, "at").first()[0] == "page-7"
    assert cursor.next_cursor(df.limit(0), "at", previous=F.lit("kept")).first()[0] == "kept"
    assert cursor.scan_since(df, "n", None, None).count() == 3
    assert cursor.scan_since(df, "n", 3, 5).count() == 2
    assert cursor.scan_since(df, "n", None, 5).count() == 1


def test_filters(spark):
    df = spark.createDataFrame([("open", True), ("closed", None), (None, False)], "state string, archived boolean")
    assert filters.state_filter(df, "state", "open").count() == 1
    assert filters.state_filter(df, "state", "all").count() == 3
    assert filters.exclude_archived(df).count() == 2
    good, bad = filters.split_rejects(df, "state = 'open'")
    assert (good.count(), bad.count()) == (1, 2)
    with pytest.raises(ValueError):
        filters.scan_scope(df, {"owner": ""}, required=("owner",))
    with pytest.raises(ValueError):
        filters.scan_scope(df, {"owner": "a", "org": "b"}, exactly_one_of=("owner", "org"))


def test_page_options():
    assert paging.batch_rows() == 5_000
    assert paging.batch_rows("500", "2") == 200
    assert paging.batch_rows("0", "x") == 50
    assert paging.batch_rows(None, None) == 5_000


def test_envelopes(spark):
    bodies = spark.createDataFrame(
        [('{"a":{"items":[{"x":1},{"x":2}]}}',), ('{"a":{}}',), ("[]",), ("bad",), (None,)], "body string"
    )
    assert [r[0] for r in paging.unnest_envelope(bodies, "body", "a.items").collect()] == ['{"x":1}', '{"x":2}']
    plain = spark.createDataFrame([('[{"x":1},"y"]',)], "body string")
    assert [r[0] for r in paging.unnest_envelope(plain, "body", None).collect()] == ['{"x":1}', '"y"']


def test_links_and_tokens(spark):
    def value(column):
        return spark.range(1).select(column).first()[0]

    header = '<https://h/items?q=1&page=2>; rel="next", <https://h/items?page=9>; rel="last"'
    assert value(shaping.next_link(F.lit(header))) == "https://h/items?q=1&page=2"
    reverse = '<https://h/items?page=9>; rel="last", <https://h/items?page=2>; rel="next"'
    assert value(shaping.next_link(F.lit(reverse))) == "https://h/items?page=2"
    assert value(shaping.next_link(F.lit('<u>; rel="last"'))) is None
    assert value(shaping.next_link(F.lit(None).cast("string"))) is None
    assert value(shaping.next_token(F.lit('{"paging":{"next":{"after":"x"}}}'))) == "x"
    assert value(shaping.clamp(F.lit("500"), 1, 100, 100)) == 100
    assert value(shaping.clamp(F.lit("x"), 1, 100, 50)) == 50


def test_id_array_forms(spark):
    texts = ['{"results":[{"id":"1"},{"x":1},{"id":null}]}', '[{"id":2},"7",{}]', None, "{}", '"odd"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["ids"] for r in df.select("i", shaping.id_array(F.try_parse_json("t")).alias("ids")).collect()}
    assert got == {0: ["1", "", None], 1: ["2", "7", ""], 2: [], 3: [], 4: []}


def test_text_rules(spark):
    df = spark.createDataFrame([("{}",), ("[]",), ("null",), ("",), ('{"a":1}',), (None,)], "j string")
    assert [r[0] for r in df.select(shaping.json_text("j")).collect()] == [None] * 4 + ['{"a":1}', None]
    numbers = spark.createDataFrame([(0.0,), (2.5,), (None,)], "n double")
    assert [r[0] for r in numbers.select(shaping.falsy_to_null("n")).collect()] == [None, "2.5", None]


def test_merge_keeps_explicit_nulls(spark):
    schema = T.StructType().add("l", T.MapType(T.StringType(), T.StringType())).add("r", T.MapType(T.StringType(), T.StringType()))
    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": None, "c": "3"}), (None, {"c": "3"}), ({"a": "1"}, None)], schema)
    rows = [r[0] for r in df.select(shaping.merge_records("l", "r")).collect()]
    assert rows == [{"a": "1", "b": None, "c": "3"}, {"c": "3"}, {"a": "1"}]


def test_detail_must_be_there(spark):
    items = spark.createDataFrame([("o", "s1"), ("o", None), ("o", "s2")], "org string, slug string")
    details = spark.createDataFrame([("o", "s1", 7)], "org string, slug string, n int").withColumnsRenamed(
        {"org": "d_org", "slug": "d_slug"}
    )
    on = {"org": "d_org", "slug": "d_slug"}
    with pytest.raises(PySparkException, match="no detail for o/s2"):
        joins.expand_detail(items, details, on, carry={"n": "n"}).collect()
    kept = joins.expand_detail(items, details, on, carry={"n": "n"}, missing="keep").collect()
    assert {(r["slug"], r["n"], r["detail_found"]) for r in kept} == {("s1", 7, True), ("s2", None, False)}


def test_nested_parts_hold_every_child(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 7).alias("p"), "id")
    nested = shape.nest_children(df, ["p"], ["id"], ["id"], max_children=50, pieces=30)
    sizes = nested.select(F.size("children").alias("n")).agg(F.max("n"), F.sum("n")).first()
    assert tuple(sizes) == (50, 1000)
    back = shape.explode_children(nested, "children", {"p": "p"}).select("p", "child.id")
    assert back.exceptAll(df).count() == 0 and back.count() == 1000


def test_shape_hooks(spark):
    shape.register_shape("t", lambda d: d.withColumn("x", F.lit(1)))
    assert shape.shape(spark.range(1), "t").columns == ["id", "x"]
    assert shape.shape(spark.range(1), "other").columns == ["id"]


def test_summary_of_nothing_passes(spark):
    empty = spark.createDataFrame([], "`table` string, `check` string, status string, value bigint")
    row = contract.report_summary(empty).first()
    assert (row["total"], row["success_rate"], row["status"]) == (0, 0.0, "passed")
    mixed = spark.createDataFrame([("t", "a", s, 1) for s in ("passed", "failed", "error")], empty.schema)
    assert contract.report_summary(mixed).first()["status"] == "error"


# -- plans ------------------------------------------------------------------------------


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_reduces_before_the_shuffle(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = _plan(latest_per_key(events, "user_id", ["ts", "event_id"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan and plan.count("Exchange") == 1


def test_bounds_and_columns_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = _plan(cursor.scan_since(events, "ts", "2024-01-20").select("event_id"))
    assert "GreaterThanOrEqual(ts" in plan and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_no_python_and_no_single_partition_on_the_record_path(spark):
    from tidemark.plans.queries import QUERIES

    for name in ("cdc_scd1", "cdc_scd2", "snapshot_diff", "conform_events", "expand_children", "append_dedupe"):
        plan = _plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "EvalPython" not in plan and "SinglePartition" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan, name
