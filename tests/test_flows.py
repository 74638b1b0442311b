"""Definitions, catalogue, targets, streams and the many-table call."""

import json
import os
import pathlib
import shutil

import pytest
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import APPEND, CDC, SNAPSHOT, TableDef, TableSource, requested_tables, text_options
from tidemark.operators import contract, joins
from tidemark.plans.ingest import ingest
from tidemark.plans.target import TargetTable
from tidemark.sources import metadata
from tidemark.sources.catalog import CATALOG
from tidemark.sources.catalog.crm import object_table
from tidemark.sources.catalog.fields import fields
from tidemark.sources.landed import LandedSource, staging_view, stream_table
from tidemark.sources.records import comment_records, table_rows
from tidemark.streaming.flows import append_flow, observe_mark, stored_with, upsert_stream
from tidemark.workspace import shared_folder

VALID = {
    "connection_name": "c",
    "objects": [
        {"table": {"source_table": "a"}},
        {"table": {"source_table": "b", "table_configuration": {"n": 1, "flag": True, "deep": {"x": [1]}}}},
    ],
}


def test_spec():
    assert requested_tables(VALID) == {"a": {}, "b": {"n": "1", "flag": "True", "deep": '{"x": [1]}'}}
    assert text_options(None) == {}


@pytest.mark.parametrize(
    "spec",
    [
        "text",
        {"objects": VALID["objects"]},
        {"connection_name": "  ", "objects": VALID["objects"]},
        {"connection_name": "c"},
        {"connection_name": "c", "objects": "a"},
        {"connection_name": "c", "objects": []},
        {"connection_name": "c", "objects": [{}]},
        {"connection_name": "c", "objects": [{"table": {}}]},
        {"connection_name": "c", "objects": VALID["objects"], "more": 1},
        {"connection_name": "c", "objects": [{"table": {"source_table": "a", "more": 1}}]},
        {"connection_name": "c", "objects": [{"table": {"source_table": "a", "table_configuration": "x"}}]},
        {"connection_name": "c", "objects": [{"table": {"source_table": "a"}}] * 2},
    ],
)
def test_bad_specs(spec):
    with pytest.raises(ValueError):
        requested_tables(spec)


@pytest.mark.parametrize(
    "table",
    [
        TableDef("t", fields("id"), (), "id"),
        TableDef("t", fields("id"), ("id",)),
        TableDef("t", fields("id"), ("id",), "x"),
        TableDef("t", fields("id"), ("y",), None, SNAPSHOT),
        TableDef("t", fields("id"), ("id",), "id", "other"),
    ],
)
def test_bad_definitions(table):
    with pytest.raises(ValueError):
        table.check()


def test_catalogue_keeps_its_contract(spark):
    sizes = {service: len(tables) for service, tables in CATALOG.items()}
    assert sizes == {"example": 2, "github": 12, "hubspot": 10, "stripe": 16, "zendesk": 8}
    for tables in CATALOG.values():
        for table in tables.values():
            table.check()
        report = contract.definition_checks(spark, tables.values())
        assert report.where("status <> 'passed'").count() == 0


@pytest.mark.parametrize("service", sorted(CATALOG))
def test_every_table_takes_a_small_record(spark, service):
    """A record with only its required fields gives one row with those values."""
    samples = {T.LongType(): 7, T.BooleanType(): True}
    for table in CATALOG[service].values():
        record: dict = {}
        for f in table.schema.fields:
            if f.name in table.scope or f.name in table.id_arrays or (f.nullable and f.name not in table.keys):
                continue
            steps = table.paths.get(f.name, f.name)
            steps = steps.split(".") if isinstance(steps, str) else steps
            at = record
            for s in steps[:-1]:
                at = at.setdefault(s, {})
            at[steps[-1]] = samples.get(f.dataType, "v")
        df = spark.createDataFrame([(json.dumps(record),)], "payload string")
        df = df.withColumns({c: F.lit("1") for c in table.scope.values()})
        (row,) = table_rows(df, table).collect()
        assert row.__fields__ == table.schema.fieldNames()
        assert all(row[k] is not None for k in table.keys)


def test_flattened_and_defaulted_columns(spark):
    record = {
        "id": "c1", "created": "12.7", "address": {"city": "Rome"}, "shipping": {"address": {"line1": "x"}, "name": "n"},
        "metadata": {}, "discount": {"z": 1, "a": {"b": [1, 2]}}, "preferred_locales": "it", "delinquent": "no",
    }
    df = spark.createDataFrame([(json.dumps(record),)], "payload string")
    row = table_rows(df, CATALOG["stripe"]["customers"]).first()
    assert (row["address_city"], row["shipping_address_line1"], row["shipping_name"]) == ("Rome", "x", "n")
    assert (row["created"], row["metadata"], row["preferred_locales"]) == (12, None, ["it"])
    assert json.loads(row["discount"]) == record["discount"] and row["delinquent"] is False
    assert row["deleted"] is False and row["address_line1"] is None


def test_objects_with_properties_and_associations(spark):
    table = object_table("deals", [("amount", "number"), ("won", "bool"), ("stage.x", "other")], {"number": T.DecimalType(9, 2)})
    record = {"id": "1", "archived": False, "properties": {"amount": "12.50", "won": "true", "stage.x": "s", "more": 1},
              "associations": {"contacts": {"results": [{"id": "9"}, {}]}, "tickets": ["5", {"id": "6"}]}}
    df = spark.createDataFrame([(json.dumps(record),)], "payload string")
    row = table_rows(df, table).first()
    assert (str(row["properties_amount"]), row["properties_won"], row["properties_stage.x"]) == ("12.50", True, "s")
    assert (row["contacts"], row["companies"], row["tickets"]) == (["9", ""], [], ["5", "6"])


def test_comments_keep_their_ticket(spark):
    event = {"id": 1, "ticket_id": 5, "created_at": "t0", "child_events": [
        {"event_type": "Comment", "id": 11, "body": "hi", "created_at": "t1"}, {"event_type": "Change", "id": 12}]}
    df = spark.createDataFrame([(json.dumps(event),), ('{"id":2}',)], "payload string")
    (row,) = table_rows(comment_records(df), CATALOG["zendesk"]["ticket_comments"]).collect()
    assert (row["id"], row["event_id"], row["ticket_id"], row["created_at"], row["body"]) == (11, 1, 5, "t1", "hi")


def test_unknown_names_fail(spark):
    asked = spark.createDataFrame([("my_table, ,nope",)], "names string")
    frame = metadata.definitions_frame(spark, CATALOG["example"].values())
    with pytest.raises(PySparkException, match="unknown table nope"):
        metadata.table_metadata(asked, "names", frame).collect()
    with pytest.raises(ValueError):
        LandedSource("/x", {}).table("nope")


# -- targets ----------------------------------------------------------------------------

ROWS = "id int, s int, v string, gone boolean"


def _frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def test_target_takes_each_batch_once_and_compacts(spark):
    target = TargetTable(spark, shared_folder(spark, "t"), "id", "s", apply_as_deletes="gone", keep_versions=2)
    target.upsert(_frame(spark, (1, 1, "a", False), (2, 1, "b", False)), 0)
    target.upsert(_frame(spark, (1, 3, "c", False), (2, 4, "b", True)), 1)
    target.upsert(_frame(spark, (1, 9, "sent again with other rows", False)), 1)
    target.upsert(_frame(spark, (1, 2, "late", False), (2, 3, "late", False), (3, 1, "d", False)), 2)
    assert {(r["id"], r["v"]) for r in target.read().collect()} == {(1, "c"), (3, "d")}
    target.compact()
    assert {(r["id"], r["v"]) for r in target.read().collect()} == {(1, "c"), (3, "d")}
    assert len(target._live()) == 1


def test_a_write_without_commit_is_not_seen(spark):
    root = shared_folder(spark, "t")
    target = TargetTable(spark, root, "id", "s")
    target.upsert(_frame(spark, (1, 1, "a", False)), 0)
    _frame(spark, (2, 1, "lost", False)).write.parquet(f"{root}/data/lost/__bucket=1")
    assert [r["id"] for r in target.read().collect()] == [1]
    target.upsert(_frame(spark, (3, 1, "c", False)), 1)
    assert sorted(r["id"] for r in target.read().collect()) == [1, 3]


def test_history_target_takes_late_rows(spark):
    target = TargetTable(spark, shared_folder(spark, "t"), "id", "s", scd_type="SCD_TYPE_2", keep_versions=2)
    target.upsert(_frame(spark, (1, 1, "a", False), (1, 5, "a", False)), 0)
    target.upsert(_frame(spark, (1, 3, "b", False)), 1)
    got = {(r["v"], r["__start_at"], r["__end_at"]) for r in target.read().collect()}
    assert got == {("a", 1, 3), ("b", 3, 5), ("a", 5, None)}


def test_stream_equals_batch_and_resumes(spark):
    root = shared_folder(spark, "s")
    target = TargetTable(spark, f"{root}/data", "id", "s")
    schema = T.StructType.fromDDL(ROWS)
    for part in range(3):
        rows = _frame(spark, *[(i, part * 10 - i, f"{part}-{i}", False) for i in range(5)])
        rows.coalesce(1).write.mode("append").parquet(f"{root}/landed")
        upsert_stream(stream_table(spark, f"{root}/landed", schema), target, f"{root}/cp").awaitTermination()
    assert {(r["id"], r["v"]) for r in target.read().collect()} == {(i, f"2-{i}") for i in range(5)}


def test_append_takes_copies_once(spark):
    root = shared_folder(spark, "a")
    rows = spark.range(10).select("id", F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("at"))
    rows.union(rows).write.parquet(f"{root}/landed")
    stream = stream_table(spark, f"{root}/landed", rows.schema)
    append_flow(stream, f"{root}/data", f"{root}/cp", keys=["id"]).awaitTermination()
    assert spark.read.parquet(f"{root}/data").count() == 10


def test_observed_mark(spark):
    seen, mark = observe_mark(spark.range(5), "id")
    seen.write.format("noop").mode("overwrite").save()
    assert mark.get == {"high_water_mark": 4, "rows": 5}


# -- many tables ------------------------------------------------------------------------


def _landed(spark, root, name, *records, **beside):
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "payload string")
    df.withColumns({k: F.lit(v) for k, v in beside.items()}).write.mode("append").parquet(f"{root}/{name}")


TABLES = {
    "issues": TableDef("issues", fields("id:long! state updated_at owner"), ("id",), "updated_at", CDC, scope={"owner": "owner"}),
    "users": TableDef("users", fields("id:long! login"), ("id",), None, SNAPSHOT),
    "commits": TableDef("commits", fields("sha! n:long"), ("sha",), None, APPEND),
}


def test_ingest_runs_again(spark):
    root = shared_folder(spark, "i")
    source = LandedSource(f"{root}/landed", TABLES)
    assert isinstance(source, TableSource)
    _landed(spark, f"{root}/landed", "issues", {"id": 1, "state": "open", "updated_at": "2024-01-01T00:00:00Z"}, owner="acme")
    _landed(spark, f"{root}/landed", "issues", {"id": 2, "state": "open", "updated_at": "2024-01-01T00:00:00Z"}, owner="other")
    _landed(spark, f"{root}/landed", "users", {"id": 1, "login": "a"})
    _landed(spark, f"{root}/landed", "commits", {"sha": "x", "n": 1})
    spec = {"issues": {"owner": "acme", "scd_type": "SCD_TYPE_2"}, "users": {"scd_type": 2}, "commits": {}}
    ingest(spark, source, spec, f"{root}/out", run_id=1)
    _landed(spark, f"{root}/landed", "issues", {"id": 1, "state": "closed", "updated_at": "2024-01-02T00:00:00Z"}, owner="acme")
    _landed(spark, f"{root}/landed", "users", {"id": 2, "login": "b"})
    _landed(spark, f"{root}/landed", "commits", {"sha": "x", "n": 1}, {"sha": "y", "n": 2})
    done = ingest(spark, source, spec, f"{root}/out", run_id=2)
    issues = {(r["id"], r["state"], r["owner"], r["__end_at"]) for r in done["issues"].read(spark).collect()}
    assert issues == {(1, "open", "acme", "2024-01-02T00:00:00Z"), (1, "closed", "acme", None)}
    users = {(r["id"], r["__start_at"], r["__end_at"]) for r in done["users"].read(spark).collect()}
    assert users == {(1, 1, None), (2, 2, None)}
    assert sorted(r["sha"] for r in done["commits"].read(spark).collect()) == ["x", "y"]
    again = ingest(spark, source, spec, f"{root}/out", run_id=2)
    assert again["users"].read(spark).count() == 2 and again["issues"].read(spark).count() == 2


def test_ingest_checks_before_it_starts(spark):
    source = LandedSource("/nowhere", {"t": TableDef("t", fields("id"), ("id",))})
    with pytest.raises(ValueError, match="needs a cursor"):
        ingest(spark, source, {"t": {}}, "/nowhere", run_id=1)


def test_bad_record_stops_its_stream(spark):
    root = shared_folder(spark, "b")
    _landed(spark, root, "issues", {"state": "no id"}, owner="acme")
    with pytest.raises(StreamingQueryException, match="required field id is absent"):
        ingest(spark, LandedSource(root, TABLES), {"issues": {}}, f"{root}/out", run_id=1)


def test_source_bounds_and_view(spark):
    root = shared_folder(spark, "v")
    records = [{"id": i, "state": "open", "updated_at": f"2024-01-0{i}T00:00:00Z"} for i in (1, 2, 3)]
    _landed(spark, root, "issues", *records, owner="acme")
    source = LandedSource(root, TABLES)
    assert source.read(spark, "issues", "2024-01-02T00:00:00Z").count() == 2
    assert source.read(spark, "issues", None, {"start_date": "2024-01-03T00:00:00Z"}).count() == 1
    name = staging_view(source.read(spark, "issues", None, {"owner": "acme", "state": "closed"}), "issues")
    assert name == "issues_staging" and spark.table(name).count() == 0


# -- identity of writes, options ----------------------------------------------------------


def test_a_new_checkpoint_is_a_new_flow(spark):
    """After a checkpoint is lost, its batch numbers start again, and its rows still count."""
    root = shared_folder(spark, "n")
    target = TargetTable(spark, f"{root}/data", "id", "s")
    schema = T.StructType.fromDDL(ROWS)
    for part in range(2):
        _frame(spark, (part, 1, f"v{part}", False)).write.mode("append").parquet(f"{root}/landed")
        rows = stream_table(spark, f"{root}/landed", schema)
        upsert_stream(rows, target, f"{root}/checkpoint-{part}").awaitTermination()
    assert {(r["id"], r["v"]) for r in target.read().collect()} == {(0, "v0"), (1, "v1")}


def test_a_repeated_snapshot_run_counts_once(spark):
    target = TargetTable(spark, shared_folder(spark, "r"), "id", scd_type=2)
    target.replace(_frame(spark, (1, 0, "a", False)), 4)
    target.replace(_frame(spark, (1, 0, "b", False)), 5)
    target.replace(_frame(spark, (1, 0, "c", False)), 5)
    got = {(r["v"], r["__start_at"], r["__end_at"]) for r in target.read().collect()}
    assert got == {("a", 4, 5), ("b", 5, None)}


def test_a_repeated_key_fails_a_snapshot(spark):
    from tidemark.operators.snapshot import snapshot_diff

    one, two = _frame(spark, (1, 0, "a", False)), _frame(spark, (None, 0, "b", False), (None, 0, "c", False))
    with pytest.raises(PySparkException, match="not unique"):
        snapshot_diff(one, two, "id").count()
    assert snapshot_diff(one, two.limit(1), "id").count() == 2


def test_checks_survive_column_pruning(spark):
    bad = spark.createDataFrame([('{"name":"no id"}',)], "payload string")
    with pytest.raises(PySparkException, match="required field id is absent"):
        table_rows(bad, TableDef("t", fields("id:long! name"))).select("name").count()
    lone = spark.createDataFrame([(1,)], "ref int")
    with pytest.raises(PySparkException, match="no detail for 1"):
        joins.expand_detail(lone, spark.createDataFrame([(2, "x")], "id int, n string"), {"ref": "id"}, carry={"n": "n"}).count()


def test_append_keeps_late_rows_and_no_repeats(spark):
    root = shared_folder(spark, "l")
    at = F.timestamp_seconds(F.col("id") * 3600 + 1_700_000_000)
    for ids in (range(20, 30), range(0, 25), range(0, 30)):
        rows = spark.createDataFrame([(i,) for i in ids], "id long").select("id", at.alias("at"))
        rows.coalesce(1).write.mode("append").parquet(f"{root}/landed")
        stream = stream_table(spark, f"{root}/landed", rows.schema, max_files=1)
        append_flow(stream, f"{root}/data", f"{root}/cp", keys=["id"]).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/data").collect()) == list(range(30))


def test_options_of_a_landed_source(spark):
    root = shared_folder(spark, "o")
    defs = {
        "t": TableDef("t", fields("id:long! updated_at archived:boolean owner repo"), ("id",), "updated_at", CDC,
                      scope={"owner": "owner", "repo": "repo"}, required=("owner", "repo"), archived=True),
    }
    records = [{"id": i, "updated_at": f"2024-01-01T00:{i:02d}:00Z", "archived": i % 2 == 0} for i in range(10)]
    _landed(spark, root, "t", *records, owner="a", repo="b")
    source, scope = LandedSource(root, defs), {"owner": "a", "repo": "b"}
    read = lambda since=None, **options: sorted(r["id"] for r in source.read(spark, "t", since, scope | options).collect())
    assert read() == [1, 3, 5, 7, 9] and read(archived="True") == list(range(10)) and read(archived="no") == read()
    assert read("2024-01-01T00:07:00Z") == [7, 9]
    assert read("2024-01-01T00:07:00Z", lookback_seconds="120") == [5, 7, 9]
    assert read(per_page="1", max_pages_per_batch="2") == [1, 3]
    for wrong in ({"owner": "a"}, scope | {"org": "x"}, scope | {"archived": "maybe"}):
        with pytest.raises(ValueError):
            source.read(spark, "t", None, wrong)
    spec = {"t": scope | {"start_date": "2024-01-01T00:05:00Z"}}
    done = ingest(spark, source, spec, f"{root}/out", run_id=1)
    assert sorted(r["id"] for r in done["t"].read(spark).collect()) == [5, 7, 9]


def test_an_incomplete_snapshot_keeps_what_it_has_not_seen(spark):
    for text, left in (("False", [1, 2]), (True, [2])):
        root = shared_folder(spark, "c")
        source = LandedSource(f"{root}/landed", TABLES)
        _landed(spark, f"{root}/landed", "users", {"id": 1, "login": "a"})
        ingest(spark, source, {"users": {}}, f"{root}/out", run_id=1)
        source = LandedSource(f"{root}/later", TABLES)
        _landed(spark, f"{root}/later", "users", {"id": 2, "login": "b"})
        done = ingest(spark, source, {"users": {"complete": text}}, f"{root}/out", run_id=2)
        assert sorted(r["id"] for r in done["users"].read(spark).collect()) == left


# -- buckets, versions and changes of a target ----------------------------------------------


def test_an_upsert_leaves_other_buckets_alone(spark):
    target = TargetTable(spark, shared_folder(spark, "b"), "id", "s", buckets=8, keep_versions=2)
    target.upsert(_frame(spark, *[(i, 1, "a", False) for i in range(200)]), 0)
    before = target._live()[-1]["buckets"]
    for number in range(1, 6):
        target.upsert(_frame(spark, (7, 1 + number, f"v{number}", False)), number)
    live = target._live()
    after = live[-1]["buckets"]
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert target.versions() == [4, 5] and live[-1]["writes"] == {"main": [[0, 5]]}
    assert {r["v"] for r in target.read().where("id = 7").collect()} == {"v5"} and target.read().count() == 200
    assert target.read(4).where("id = 7").first()["v"] == "v4"
    plan = target.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    import glob

    folders = glob.glob(f"{target.root}/data/*/__bucket=*")
    assert len(folders) == 9  # those of the first write that are still in use, and the one bucket of the last two versions
    with pytest.raises(ValueError, match="isn't kept"):
        target.read(0)


def test_changes_between_versions(spark):
    target = TargetTable(spark, shared_folder(spark, "f"), "id", "s", apply_as_deletes="gone")
    target.upsert(_frame(spark, *[(i, 1, "a", False) for i in range(50)]), 0)
    target.upsert(_frame(spark, (3, 2, "b", False), (4, 2, "x", True), (60, 2, "new", False), (5, 0, "late", False)), 1)
    target.upsert(_frame(spark, (6, 9, "c", False)), 2)
    feed = lambda *v: {(r["id"], r["v"], r["change_type"]) for r in target.changes(*v).collect()}
    assert feed(0, 1) == {(3, "b", "update"), (4, "a", "delete"), (60, "new", "insert")} == feed(0, 1)
    assert feed(1) == {(6, "c", "update")} and feed(2, 2) == set()


@pytest.mark.parametrize("seed", range(3))
def test_stored_history_equals_one_from_all_changes(spark, seed):
    import random

    from tidemark.operators.changes import apply_changes

    rnd = random.Random(seed)
    rows = [(rnd.randrange(12), n, rnd.choice("ab"), rnd.random() < 0.1) for n in range(200)]
    rnd.shuffle(rows)
    target = TargetTable(spark, shared_folder(spark, "h"), "id", "s", scd_type=2, apply_as_deletes="gone", buckets=3)
    for number in range(6):
        target.upsert(_frame(spark, *rows[number::6]), number)
    want = apply_changes(_frame(spark, *rows), "id", "s", scd_type=2, apply_as_deletes="gone")
    shown = lambda df: sorted(map(tuple, df.select("id", "s", "v", "__start_at", "__end_at").collect()))
    assert shown(target.read()) == shown(want)
    plan = target.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


@pytest.mark.parametrize("scd_type", [1, 2])
def test_a_snapshot_writes_differing_buckets_alone(spark, scd_type):
    target = TargetTable(spark, shared_folder(spark, "d"), "id", scd_type=scd_type, buckets=8)
    rows = [(i, 0, None if i % 5 else "a", False) for i in range(100)]
    target.replace(_frame(spark, *rows), 1)
    before = target._live()[-1]["buckets"]
    target.replace(_frame(spark, *rows).orderBy(F.desc("id")), 2)
    assert target._live()[-1]["buckets"] == before
    target.replace(_frame(spark, *[r for r in rows if r[0] != 7], (200, 0, "n", False)), 3)
    after = target._live()[-1]["buckets"]
    assert 1 <= sum(before[b] != after[b] for b in before) <= 2
    current = target.read() if scd_type == 1 else target.read().where("__end_at is null")
    assert {r["id"] for r in current.collect()} == {*range(100), 200} - {7}
    target.replace(_frame(spark), 4)
    assert (target.read() if scd_type == 1 else target.read().where("__end_at is null")).count() == 0


def test_columns_of_a_target_may_grow(spark):
    target = TargetTable(spark, shared_folder(spark, "w"), "id", "s")
    target.upsert(spark.createDataFrame([(1, 1, 5)], "id int, s int, n int"), 0)
    target.upsert(spark.createDataFrame([(2, 1, 2**40, "x")], "id int, s int, n long, more string"), 1)
    target.upsert(spark.createDataFrame([(3, 1)], "id int, s int"), 2)
    assert {tuple(r) for r in target.read().collect()} == {(1, 1, 5, None), (2, 1, 2**40, "x"), (3, 1, None, None)}
    with pytest.raises(ValueError, match="can't become"):
        target.upsert(spark.createDataFrame([(2, 1, "text")], "id int, s int, n string"), 3)


def test_an_append_opens_the_files_that_may_hold_its_keys(spark):
    root = shared_folder(spark, "k")
    ids = lambda *values: spark.createDataFrame([(i, str(i)) for i in values], "id long, v string")
    schema = ids(1).schema
    batches = [range(100), range(100, 200), range(150, 300), [5, 250, 999, None], range(0, 300, 7)]
    for values in batches:
        ids(*values).coalesce(1).write.mode("append").parquet(f"{root}/landed")
        append_flow(stream_table(spark, f"{root}/landed", schema), f"{root}/data", f"{root}/cp", keys=["id"]).awaitTermination()
    got = [r["id"] for r in spark.read.parquet(f"{root}/data").collect()]
    assert sorted(i for i in got if i is not None) == [*range(300), 999] and got.count(None) == 1
    files = lambda rows: {f.rsplit("/", 2)[1] for f in rows.inputFiles()}
    name = lambda rows: {f[-1] for f in files(rows)}
    assert name(stored_with(spark, f"{root}/data", ids(3, 90), "id")) == {"0"}
    assert name(stored_with(spark, f"{root}/data", ids(120, 199), "id")) == {"1"}
    assert stored_with(spark, f"{root}/data", ids(5000), "id") is None
    assert "3" in name(stored_with(spark, f"{root}/data", ids(None, 4), "id"))
    shutil.rmtree(f"{root}/data/_keys/{next(f for f in os.listdir(f'{root}/data/_keys') if f.endswith('-1'))}")
    assert name(stored_with(spark, f"{root}/data", ids(3), "id")) == {"0", "1"}  # without an index a batch is read as a whole


@pytest.mark.parametrize("mode", [CDC, APPEND])
def test_ingest_in_batches_of_rows(spark, mode):
    root = shared_folder(spark, "p")
    source = LandedSource(f"{root}/landed", {"t": TableDef("t", fields("id:long! updated_at v"), ("id",), "updated_at", mode)})
    record = lambda i, minute, v="a": {"id": i, "updated_at": f"2024-01-01T00:{minute:02d}:00Z", "v": v}
    # Ten rows share each cursor, so that batches of seven end inside a group.
    _landed(spark, f"{root}/landed", "t", *[record(i, 10 + i // 10) for i in range(40)])
    options = {"t": {"per_page": "7", "max_pages_per_batch": "1"}}
    done = ingest(spark, source, options, f"{root}/out", run_id=1)
    assert sorted(r["id"] for r in done["t"].read(spark).collect()) == list(range(40))
    marks = spark.read.json(f"{root}/out/t/marks")
    assert marks.where("done").agg(F.max("rows"), F.max("n")).first() == (7, 5)
    # Three and five minutes behind the mark, and six, which is out of sight; and newer ones.
    _landed(spark, f"{root}/landed", "t", record(50, 10), record(51, 8), record(52, 7), record(53, 13), record(54, 20))
    done = ingest(spark, source, options, f"{root}/out", run_id=2)
    assert sorted(r["id"] for r in done["t"].read(spark).collect()) == [*range(40), 50, 51, 53, 54]
    assert len(list((pathlib.Path(root) / "out/t/marks").glob("batch=*"))) <= 3


def test_a_batch_that_was_cut_short_is_finished(spark):
    from tidemark.streaming.keyset import Marks, drain

    root = shared_folder(spark, "q")
    rows = spark.createDataFrame([(i, i // 4) for i in range(10)], "id long, c long")
    read = lambda since: rows if since is None else rows.where(F.col("c") >= since)
    taken: list[list[int]] = []

    def apply(batch, n):
        got = sorted(r["id"] for r in batch.collect())
        if n == 1 and len(taken) == 1:
            taken.append([])
            raise RuntimeError("lost")
        taken.append(got)

    with pytest.raises(RuntimeError):
        drain(spark, read, "c", ["id"], 3, apply, f"{root}/marks")
    assert [m["done"] for m in Marks(spark, f"{root}/marks").last()] == [False, True]
    drain(spark, read, "c", ["id"], 3, apply, f"{root}/marks")
    assert taken == [[0, 1, 2], [], [3, 4, 5], [6, 7, 8], [9]]
    assert drain(spark, read, "c", ["id"], 3, apply, f"{root}/marks", lookback=1) == 1 and taken[-1] == list(range(4, 10))


def test_drain_reads_the_source_once_a_run(spark):
    """batches take their rows from one read of the source, not from a read of all of it each."""
    from tidemark.streaming.keyset import drain
    from tidemark.workspace import shared_folder

    root = shared_folder(spark, "q")
    rows = spark.createDataFrame([(i, i // 4) for i in range(10)] + [(3, 0)], "id long, c long")
    reads: list[object] = []

    def read(since):
        reads.append(since)
        return rows if since is None else rows.where(F.col("c") >= since)

    taken: list[list[int]] = []
    assert drain(spark, read, "c", ["id"], 3, lambda batch, n: taken.append(sorted(r["id"] for r in batch.collect())), f"{root}/marks") == 4
    assert taken == [[0, 1, 2], [3, 3, 4], [5, 6, 7], [8, 9]]
    assert len(reads) == 2  # the schema, and the rows after the mark


def _jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def test_jobs_of_a_run_do_not_grow_with_its_batches(spark):
    """many batches are worked out together; each is still a version of its own, with marks of its own."""
    took = {}
    record = lambda i: {"id": i % 30, "updated_at": f"2024-01-01T00:{i:02d}:00Z", "v": f"v{i}" if i % 4 else "gone"}
    for size in (6, 20):
        root = shared_folder(spark, "j")
        source = LandedSource(f"{root}/landed", {"t": TableDef("t", fields("id:long! updated_at v"), ("id",), "updated_at")})
        _landed(spark, f"{root}/landed", "t", *[record(i) for i in range(60)])
        before = _jobs(spark)
        options = {"per_page": str(size), "max_pages_per_batch": "1", "apply_as_deletes": "v = 'gone'"}
        target = ingest(spark, source, {"t": options}, f"{root}/out", run_id=1)["t"].target
        took[size] = _jobs(spark) - before
        last = 60 // size - 1
        assert target._live()[-1]["writes"] == {"rows": [[0, last]]} and target.versions() == list(range(last + 1))
        latest = lambda n: {r["id"]: r["v"] for r in map(record, range(n))}
        for v in target.versions():
            rows = [tuple(r) for r in target.read(v).select("id", "v").collect()]
            assert sorted(rows) == sorted((k, x) for k, x in latest((v + 1) * size).items() if x != "gone")
        plan = target.read()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan
        feed = {(r["id"], r["v"], r["change_type"]) for r in target.changes(last - 1).collect()}
        old, new = latest(last * size), latest(60)
        kind = lambda k: "delete" if new[k] == "gone" else "insert" if old.get(k, "gone") == "gone" else "update"
        assert feed == {(k, old[k] if kind(k) == "delete" else new[k], kind(k)) for k in new if new[k] != old.get(k, "gone")}
        marks = spark.read.json(f"{root}/out/t/marks").where("done")
        assert marks.agg(F.min("rows"), F.max("rows"), F.max("n"), F.max("seen")).first() == (size, size, last, "2024-01-01T00:59:00Z")
    assert took[6] == took[20]


@pytest.mark.parametrize("together", [False, True])
@pytest.mark.parametrize("seed", range(2))
def test_batches_end_behind_rows_of_one_place(spark, seed, together):
    import random

    from tidemark.streaming.keyset import NUMBER, drain

    rng = random.Random(seed)
    pairs = [(rng.choice([None, 0, 1, 2, 3, 4]), rng.randrange(4)) for _ in range(60)]
    rows = spark.createDataFrame([(i, c) for c, i in pairs], "id long, c long")
    read = lambda since: rows if since is None else rows.where(F.col("c") >= since)
    place = lambda p: (p[0] is not None, p)
    left, expected = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1])), []
    while left:  # the next five rows, and those of the same place as the last of them
        n = 5
        while n < len(left) and place(left[n]) == place(left[n - 1]):
            n += 1
        expected.append(sorted(i for _, i in left[:n]))
        left = left[n:]
    taken: dict[int, list[int]] = {}

    def prepare(batches, number, last):
        found = batches.groupBy(number).agg(F.sort_array(F.collect_list("id")).alias("ids")).collect()
        return lambda n: taken.update({n: next(r["ids"] for r in found if r[NUMBER] == n)})

    apply = lambda batch, n: taken.update({n: sorted(r["id"] for r in batch.collect())})
    count = drain(spark, read, "c", ["id"], 5, apply, f"{shared_folder(spark, 'e')}/marks", prepare=prepare if together else None)
    assert count == len(expected) and [taken[n] for n in sorted(taken)] == expected


@pytest.mark.parametrize("committed", [False, True])
def test_prepared_batches_that_were_cut_short(spark, committed):
    from tidemark.streaming.keyset import drain

    root = shared_folder(spark, "r")
    rows = spark.createDataFrame([(i % 7, i, f"v{i}") for i in range(20)], "id long, s long, v string")
    read = lambda since: rows if since is None else rows.where(F.col("s") >= since)
    target = TargetTable(spark, f"{root}/data", "id", "s", buckets=4)
    latest = lambda n: sorted({i % 7: (i % 7, f"v{i}") for i in range(n)}.values())
    stored = lambda: sorted(tuple(r) for r in target.read().select("id", "v").collect())

    def lost(batches, number, last):
        commit = target.prepare(batches, number, "rows", last=last)

        def until(n):
            if n < 2 or committed:
                commit(n)
            if n == 2:
                raise RuntimeError("lost")

        return until

    run = lambda prepare: drain(
        spark, read, "s", ["id"], 3, lambda batch, n: target.upsert(batch, n, "rows"), f"{root}/marks", lookback=2, prepare=prepare
    )
    with pytest.raises(RuntimeError, match="lost"):
        run(lost)
    assert stored() == latest(9 if committed else 6)
    assert run(lambda *found: target.prepare(*found[:2], "rows", last=found[2])) == 5
    assert stored() == latest(20) and target._live()[-1]["writes"] == {"rows": [[0, 6]]}
    assert not any(e.get("parts") for e in target._live()[-1]["buckets"].values())
