"""Bucketed tables, the operation ledger, versions by day, and views that follow changes."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import date, datetime
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.operators import scd2
from siltstone.operators.expectations import Expectation, ExpectationError
from siltstone.operators.joins import Lookup, resolve_keys
from siltstone.operators.keyed import KEY_BUCKET, bucket_column, with_buckets
from siltstone.plans import gold, runs
from siltstone.plans.control import OPERATIONS, RUN_LOG
from siltstone.plans.gold import Views, changed_keys
from siltstone.plans.runs import apply_scd2, run_scd2
from siltstone.sinks.ledger import Ledger, last_operation
from siltstone.sinks import upsert as upserts
from siltstone.sinks.publish import publish_table, table_partitions
from siltstone.sinks.upsert import Merged, matched_rows, read_state, rebucket_table, upsert_table
from siltstone.specs import Scd2Spec, TableSpec, table_specs
from siltstone.streaming.ingest import ingest_batch, ingest_stream, query_id

DDL = "id int, v string, day int"


def frame(spark, data, ddl=DDL):
    return spark.createDataFrame(data, ddl)


def files_of(spark, table):
    """Files of each partition."""
    spark.catalog.refreshTable(table)
    held = {}
    for file in spark.table(table).inputFiles():
        held.setdefault("/".join(p for p in file.split("/") if "=" in p), set()).add(file)
    return held


def ledger_of(spark, layers, **batch):
    return Ledger(spark, layers.metadata_table(OPERATIONS), **batch)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Buckets


def test_untouched_buckets_keep_folder_and_files(spark, layers, rows):
    table = layers.silver_table("t")
    upsert_table(frame(spark, [(k, "a", k % 3) for k in range(200)] + [(None, "n", 0)]), table, ["id"], buckets=16)
    before = files_of(spark, table)
    assert len(before) == 16
    batch = frame(spark, [(5, "b", 1), (900, "c", 1)])
    hit = {r[0] for r in with_buckets(batch, ["id"], 16).select(f"{KEY_BUCKET}16").collect()}
    merged = upsert_table(batch, table, ["id"], buckets=16)
    assert merged == Merged(1, 1) and merged.rows_copied < 60
    after = files_of(spark, table)
    changed = {k for k in before if before[k] != after[k]}
    assert changed == {f"{KEY_BUCKET}16={b}" for b in hit} and len(changed) <= 2
    state = {k: ("a", k % 3) for k in range(200)} | {5: ("b", 1), 900: ("c", 1)}
    got = read_state(spark, table)
    assert got.columns == ["id", "v", "day"]
    assert rows(got) == sorted([(k, *v) for k, v in state.items()] + [(None, "n", 0)], key=repr)


def test_the_table_says_how_many_buckets_it_has(spark, layers, rows):
    table = layers.silver_table("t")
    upsert_table(frame(spark, [(k, "a", 0) for k in range(40)]), table, ["id"], buckets=4)
    assert upsert_table(frame(spark, [(7, "b", 0)]), table, ["id"]) == Merged(0, 1)
    assert upsert_table(frame(spark, [(8, "c", 0)]), table, ["id"], buckets=32) == Merged(0, 1)
    assert bucket_column(spark.table(table).columns) == f"{KEY_BUCKET}4"
    rebucket_table(spark, table, ["id"], 32)
    assert bucket_column(spark.table(table).columns) == f"{KEY_BUCKET}32"
    assert upsert_table(frame(spark, [(9, "d", 0)]), table, ["id"]) == Merged(0, 1)
    assert rows(read_state(spark, table).filter("v <> 'a'"), "id", "v") == [(7, "b"), (8, "c"), (9, "d")]
    rebucket_table(spark, table, ["id"], 0)
    assert spark.table(table).columns == ["id", "v", "day"] and spark.table(table).count() == 40


def test_a_key_of_another_number_type_finds_its_bucket(spark, layers, rows):
    table = layers.silver_table("t")
    upsert_table(frame(spark, [(k, "a", 0) for k in range(40)]), table, ["id"], buckets=8)
    wide = frame(spark, [(11, "b", 0)], "id long, v string, day int")
    assert upsert_table(wide, table, ["id"]) == Merged(0, 1)
    assert spark.table(table).count() == 40


def test_declared_buckets(spark, layers):
    entry = {"table_name": "T", "cdc_column": "ts", "primary_keys": ["id"], "key_buckets": 12}
    assert table_specs([entry])[0].key_buckets == 12
    for wrong in ({"key_buckets": -1}, {"primary_keys": []}):
        with pytest.raises(ValueError, match="key_buckets"):
            table_specs([{**entry, **wrong}])


batches = st.lists(
    st.dictionaries(st.integers(0, 9), st.tuples(st.sampled_from("abc"), st.integers(0, 2)), min_size=1), min_size=1, max_size=3
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches)
def test_bucketed_and_partitioned_upserts_fold_like_a_dictionary(spark, layers, rows, batches):
    """Keys may change partition, and guarded rows lose against newer ones."""
    table = layers.silver_table(f"t{abs(hash(repr(batches)))}")
    state, newest = {}, {}
    for batch in batches:
        data = frame(spark, [(k, *v) for k, v in batch.items()]).persist()
        upsert_table(data, table, ["id"], ["day"], buckets=4)
        upsert_table(data, f"{table}_g", ["id"], ["day"], guard_order="v", buckets=4)
        state.update(batch)
        newest.update({k: v for k, v in batch.items() if k not in newest or newest[k][0] <= v[0]})
    assert rows(read_state(spark, table), "id", "v", "day") == sorted([(k, *v) for k, v in state.items()], key=repr)
    assert rows(read_state(spark, f"{table}_g"), "id", "v", "day") == sorted([(k, *v) for k, v in newest.items()], key=repr)


def test_matched_rows_take_one_narrow_pruned_scan(spark, layers):
    table = layers.silver_table("t")
    upsert_table(frame(spark, [(k, "a", k % 3) for k in range(100)]), table, ["id"], ["day"], buckets=8)
    batch = frame(spark, [(40, "x", 0), (44, "y", 1)])
    batch = with_buckets(batch, ["id"], 8).select("id", "v", "day", f"{KEY_BUCKET}8")
    found = matched_rows(spark.table(table), batch, ["id"], ["day", f"{KEY_BUCKET}8"])
    plan = plan_of(found)
    assert plan.count("FileScan parquet") == 1
    assert "ReadSchema: struct<id:int>" in plan and "GreaterThanOrEqual(id,40)" in plan
    buckets = {r[0] for r in batch.select(f"{KEY_BUCKET}8").collect()}
    read = {part for file in found.inputFiles() for part in file.split("/") if part.startswith(KEY_BUCKET)}
    assert read <= {f"{KEY_BUCKET}8={b}" for b in buckets}
    assert sorted(r["id"] for r in found.collect()) == [40, 44]


# Ledger


def test_last_operation(spark, layers, rows):
    ledger, one, two = ledger_of(spark, layers), layers.silver_table("one"), layers.silver_table("two")
    upsert_table(frame(spark, [(1, "a", 1), (2, "a", 2)]), one, ["id"], ["day"], ledger=ledger)
    upsert_table(frame(spark, [(2, "b", 3), (3, "b", 3)]), one, ["id"], ["day"], ledger=ledger)
    publish_table(frame(spark, [(1, "a", 1)]), two, ledger=ledger)
    last = last_operation(spark.table(ledger.name), [one, two])
    assert rows(last, "table_name", "version", "operation", "rows_read", "rows_inserted", "rows_updated", "rows_written") == [
        (one.lower(), 2, "UPSERT", 2, 1, 1, 2), (two.lower(), 1, "CREATE", 1, 1, 0, 1),
    ]
    assert ledger.version(one) == 2 and ledger.version("none.such") == 0
    assert ledger.touched(one, 1, ["day"]) == {("2",), ("3",)}
    assert ledger.touched(one, 2, ["day"]) == set()
    assert ledger.touched(one, 0, ["day"]) is None
    assert ledger.touched(one, 1, ["month"]) is None
    location = last.filter(F.col("table_name") == two.lower()).first()["location"]
    assert spark.read.parquet(location).count() == 1


def test_a_started_operation_counts_as_a_change(spark, layers, monkeypatch):
    ledger, table = ledger_of(spark, layers), layers.silver_table("t")
    upsert_table(frame(spark, [(1, "a", 1)]), table, ["id"], ["day"], ledger=ledger)
    import siltstone.sinks.upsert as upsert

    def dies(*_):
        raise RuntimeError("gone")

    monkeypatch.setattr(upsert, "swap_partitions", dies)
    with pytest.raises(RuntimeError, match="gone"):
        upsert_table(frame(spark, [(1, "b", 2)]), table, ["id"], ["day"], ledger=ledger)
    assert ledger.touched(table, 1, ["day"]) == {("1",), ("2",)}
    assert last_operation(spark.table(ledger.name), [table]).first()["version"] == 1


def test_a_batch_handed_out_again_does_nothing(spark, layers, rows):
    spec = TableSpec("Items", "ts", ("id",), "ts")
    frame(spark, [(1, "a", datetime(2026, 3, 1))], "id int, v string, ts timestamp").write.parquet(f"{layers.bronze(spec)}/one")
    ingest_stream(spark, spec, layers)
    table, log = layers.silver_table("Items"), layers.metadata_table(RUN_LOG)
    before = files_of(spark, table)
    checkpoint = Path(layers.stream_state(spec, "checkpoint"))
    for file in (checkpoint / "commits").glob("*0*"):
        file.unlink()
    ingest_stream(spark, spec, layers)
    assert files_of(spark, table) == before
    assert rows(spark.table(log), "status", "batch_id") == [("SUCCESS", "0")]
    assert ledger_of(spark, layers).version(table) == 1
    query = query_id(spark, str(checkpoint))
    assert query == json.loads((checkpoint / "metadata").read_text())["id"]
    paths = spark.createDataFrame([(f,) for f in spark.read.parquet(f"{layers.bronze(spec)}/one").inputFiles()], "path string")
    ingest_batch(spark, spec, layers, paths, 0, "another stream")
    assert ledger_of(spark, layers).version(table) == 2


# Versions by day

SPEC = Scd2Spec("dim", "src", ("id",), ("name",), "dim_key")


def users(spark, state):
    return frame(spark, list(state.items()), "id int, name string")


def at(day, hour=0):
    return datetime(2026, 3, day, hour)


def versions(spark, layers, rows):
    return rows(spark.table(layers.gold_table("dim")), "id", "name", "start_date", "end_date", "is_current")


def test_older_days_keep_their_files(spark, layers, rows):
    silver, gold = layers.silver_table("src"), layers.gold_table("dim")
    for day, state in ((1, {1: "a", 2: "a"}), (2, {1: "b", 2: "a"}), (3, {1: "b", 2: "c"})):
        publish_table(users(spark, state), silver)
        run_scd2(spark, layers, [SPEC], at(day))
    assert table_partitions(spark, gold) == {(None,), ("2026-03-02",), ("2026-03-03",)}
    before = files_of(spark, gold)
    publish_table(users(spark, {1: "z", 2: "c", 3: "n"}), silver)
    assert run_scd2(spark, layers, [SPEC], at(4)) == 2
    after = files_of(spark, gold)
    assert after["end_date=2026-03-02"] == before["end_date=2026-03-02"]
    assert after["end_date=2026-03-03"] == before["end_date=2026-03-03"]
    d = lambda n: date(2026, 3, n)
    assert versions(spark, layers, rows) == sorted([
        (1, "a", d(1), d(2), False), (1, "b", d(2), d(4), False), (1, "z", d(4), None, True), (2, "a", d(1), d(3), False),
        (2, "c", d(3), None, True), (3, "n", d(4), None, True),
    ], key=repr)
    last = last_operation(spark.table(layers.metadata_table(OPERATIONS)), [gold]).first()
    assert (last["operation"], last["rows_inserted"], last["rows_updated"]) == ("VERSION", 2, 1)


def test_two_runs_of_a_day_and_everything_gone(spark, layers, rows):
    silver, strict = layers.silver_table("src"), replace(SPEC, expire_missing=True)
    for hour, state in ((1, {1: "a"}), (2, {1: "b"}), (3, {1: "c"}), (4, {})):
        publish_table(users(spark, state), silver)
        apply_scd2(spark, layers, strict, at(1, hour))
    assert [(r[1], r[4]) for r in versions(spark, layers, rows)] == [("a", False), ("b", False), ("c", False)]
    publish_table(users(spark, {1: "a"}), silver)
    assert apply_scd2(spark, layers, strict, at(2)) == 1
    assert len(versions(spark, layers, rows)) == 4


def test_a_run_that_died_between_its_partitions_is_repaired(spark, layers, rows, monkeypatch):
    silver = layers.silver_table("src")
    publish_table(users(spark, {1: "a", 2: "a"}), silver)
    apply_scd2(spark, layers, SPEC, at(1))
    publish_table(users(spark, {1: "b", 2: "a"}), silver)
    moved = runs.swap_partitions

    def half(spark, table, partition_by, location, replaced):
        """The closed rows arrive, the open ones do not move any more."""
        spark.sql(f"ALTER TABLE {table} ADD PARTITION (end_date = '2026-03-02') LOCATION '{location}/end_date=2026-03-02'")
        raise RuntimeError("gone")

    monkeypatch.setattr(runs, "swap_partitions", half)
    with pytest.raises(RuntimeError, match="gone"):
        apply_scd2(spark, layers, SPEC, at(2))
    monkeypatch.setattr(runs, "swap_partitions", moved)
    spark.catalog.refreshTable(layers.gold_table("dim"))
    assert len(versions(spark, layers, rows)) == 3
    apply_scd2(spark, layers, SPEC, at(2, 1))
    assert [(r[0], r[1], r[4]) for r in versions(spark, layers, rows)] == [(1, "a", False), (1, "b", True), (2, "a", True)]


def test_a_dimension_kept_whole_is_laid_out_by_day(spark, layers, rows):
    silver, gold = layers.silver_table("src"), layers.gold_table("dim")
    source = users(spark, {1: "a"})
    empty = spark.createDataFrame([], scd2.dimension_schema(source.schema, SPEC))
    publish_table(scd2.scd2_apply(empty, source, SPEC, at(1)), gold)
    publish_table(users(spark, {1: "b"}), silver)
    apply_scd2(spark, layers, SPEC, at(2))
    assert table_partitions(spark, gold) == {(None,), ("2026-03-02",)}
    assert [(r[1], r[4]) for r in versions(spark, layers, rows)] == [("a", False), ("b", True)]


def test_detection_reads_open_versions_only(spark, layers):
    silver, gold = layers.silver_table("src"), layers.gold_table("dim")
    for day, name in ((1, "a"), (2, "b")):
        publish_table(users(spark, {1: name}), silver)
        apply_scd2(spark, layers, SPEC, at(day))
    open_rows = spark.table(gold).filter(F.col("end_date").isNull())
    changes = scd2.scd2_changes(open_rows, spark.table(silver), SPEC, at(3))
    assert "PartitionFilters: [isnull(end_date" in plan_of(changes)
    assert [f for f in changes.inputFiles() if "end_date=2026" in f] == []


# Views that follow a table


def model(view_day="day"):
    views = Views()

    def names(silver, gold):
        return {"names": Lookup(silver("names"), ("id",), ("name",))}

    @views.follow("named", "events", partition_by=(view_day,), lookups=names, expectations=[Expectation("positive", "n > 0")])
    def named(events, lookups):
        return resolve_keys(events, list(lookups.values()))

    return views


def events(spark, data):
    return frame(spark, data, "k int, id int, n int, day int")


def setup(spark, layers):
    ledger = ledger_of(spark, layers)
    publish_table(frame(spark, [(1, "one"), (2, "two")], "id int, name string"), layers.silver_table("names"))
    data = [(10, 1, 5, 1), (11, 2, 5, 2), (12, 3, 5, 3), (13, None, 5, 4)]
    upsert_table(events(spark, data), layers.silver_table("events"), ["k"], ["day"], ledger=ledger)
    return ledger


def view_rows(spark, layers, rows):
    return rows(spark.table(layers.gold_table("named")), "k", "n", "name")


def test_only_affected_partitions_are_refreshed(spark, layers, rows):
    ledger, views = setup(spark, layers), model()
    assert views.refresh(spark, layers)["named"].rows == 4
    before = files_of(spark, layers.gold_table("named"))
    assert views.refresh(spark, layers)["named"].rows == 0
    assert files_of(spark, layers.gold_table("named")) == before

    # A name changes, one comes, and a row moves from one day to another.
    publish_table(frame(spark, [(1, "uno"), (2, "two"), (3, "three")], "id int, name string"), layers.silver_table("names"))
    assert views.refresh(spark, layers)["named"].rows == 2
    after = files_of(spark, layers.gold_table("named"))
    assert {k for k in before if before[k] != after[k]} == {"day=1", "day=3"}
    upsert_table(events(spark, [(13, 2, 6, 2)]), layers.silver_table("events"), ["k"], ["day"], ledger=ledger)
    views.refresh(spark, layers)
    last = files_of(spark, layers.gold_table("named"))
    assert {k for k in after if after[k] != last.get(k)} == {"day=2", "day=4"} and "day=4" not in last
    assert view_rows(spark, layers, rows) == [(10, 5, "uno"), (11, 5, "two"), (12, 5, "three"), (13, 6, "two")]


def test_expectations_hold_before_a_partition_is_replaced(spark, layers, rows):
    ledger, views = setup(spark, layers), model()
    views.refresh(spark, layers)
    upsert_table(events(spark, [(14, 1, 0, 9)]), layers.silver_table("events"), ["k"], ["day"], ledger=ledger)
    with pytest.raises(ExpectationError) as caught:
        views.refresh(spark, layers)
    assert caught.value.violations == {"positive": 1}
    assert len(view_rows(spark, layers, rows)) == 4
    upsert_table(events(spark, [(14, 1, 1, 9)]), layers.silver_table("events"), ["k"], ["day"], ledger=ledger)
    views.refresh(spark, layers)
    assert view_rows(spark, layers, rows)[-1] == (14, 1, "one")


def test_a_table_replaced_whole_refreshes_the_view_whole(spark, layers, rows):
    ledger, views = setup(spark, layers), model()
    views.refresh(spark, layers)
    publish_table(events(spark, [(1, 1, 1, 7)]), layers.silver_table("events"), ["day"], ledger=ledger)
    views.refresh(spark, layers)
    assert view_rows(spark, layers, rows) == [(1, 1, "one")]


def test_a_followed_table_needs_partitions_and_views_can_be_named(spark, layers):
    setup(spark, layers)
    with pytest.raises(ValueError, match="partitions"):
        Views().follow("v", "events")
    assert model().refresh(spark, layers, []) == {}


def test_changed_keys(spark, rows):
    before = frame(spark, [(1, "a"), (2, "b"), (3, None)], "id int, name string")
    after = frame(spark, [(1, "a"), (2, "c"), (4, "d"), (3, None)], "id int, name string")
    assert rows(changed_keys(before, after, ["id"])) == [(2,), (4,)]


def test_a_refresh_that_is_whole_anyway_and_new_rows_alone_need_no_joins(spark, layers, rows, monkeypatch):
    ledger, views = setup(spark, layers), model()
    views.refresh(spark, layers)
    publish_table(frame(spark, [(1, "uno"), (2, "two")], "id int, name string"), layers.silver_table("names"))

    def unneeded(*_):
        raise AssertionError("not needed")

    monkeypatch.setattr(upserts, "without_keys", unneeded)
    monkeypatch.setattr(gold, "changed_keys", unneeded)
    more = events(spark, [(20 + day, 1, 1, day) for day in (1, 2, 3, 4)])
    assert upsert_table(more, layers.silver_table("events"), ["k"], ["day"], ledger=ledger) == Merged(4, 0)
    assert views.refresh(spark, layers)["named"].rows == 8
    assert view_rows(spark, layers, rows)[0] == (10, 5, "uno")
