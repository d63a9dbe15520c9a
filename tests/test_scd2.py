from __future__ import annotations

from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from siltstone.operators.scd2 import (
    attribute_hash,
    dimension_schema,
    duplicate_keys,
    scd2_apply,
    scd2_changes,
    scd2_merge,
)
from siltstone.plans.runs import apply_scd2, run_scd2
from siltstone.sinks.publish import publish_table
from siltstone.specs import Scd2Spec

SPEC = Scd2Spec("dim", "src", ("id",), ("name", "plan"), "dim_key", {"updated_at": "source_updated_at"})
DDL = "id int, name string, plan string, updated_at date"
DAY = date(2026, 1, 1)
source_state = st.dictionaries(
    st.integers(0, 4),
    st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", "y"])),
    max_size=5,
)


def frame(spark, state):
    return spark.createDataFrame([(k, n, p, DAY) for k, (n, p) in state.items()], DDL)


def empty(spark, spec=SPEC):
    return spark.createDataFrame([], dimension_schema(frame(spark, {}).schema, spec))


def test_versions_of_a_key(spark, rows):
    dim = empty(spark)
    for stamp, state in (
        ("2026-03-01 10:00:00", {1: ("a", "x"), 2: ("b", "x")}),
        ("2026-03-02 10:00:00", {1: ("a", "y"), 2: ("b", "x"), 3: ("c", "x")}),
    ):
        dim = scd2_apply(dim, frame(spark, state), SPEC, stamp)
    assert dim.columns == list(SPEC.columns)
    got = rows(dim, "id", "plan", "start_date", "end_date", "is_current", "record_start_ts", "record_end_ts")
    first, second = datetime(2026, 3, 1, 10), datetime(2026, 3, 2, 10)
    assert got == sorted(
        [
            (1, "x", first.date(), second.date(), False, first, second),
            (1, "y", second.date(), None, True, second, None),
            (2, "x", first.date(), None, True, first, None),
            (3, "x", second.date(), None, True, second, None),
        ],
        key=repr,
    )
    assert dim.select("dim_key").distinct().count() == 4


def test_missing_keys_stay_unless_told_otherwise(spark, rows):
    dim = scd2_apply(empty(spark), frame(spark, {1: ("a", "x")}), SPEC, "2026-03-01 00:00:00")
    assert rows(scd2_apply(dim, frame(spark, {}), SPEC, "2026-03-02 00:00:00"), "is_current") == [(True,)]
    strict = Scd2Spec(**{**SPEC.__dict__, "expire_missing": True})
    gone = scd2_apply(dim, frame(spark, {}), strict, "2026-03-02 00:00:00")
    assert rows(gone, "is_current", "end_date") == [(False, date(2026, 3, 2))]


def test_null_key_is_new_each_time(spark, rows):
    source = spark.createDataFrame([(None, "a", "x", DAY)], DDL)
    dim = scd2_apply(empty(spark), source, SPEC, "2026-03-01 00:00:00")
    dim = scd2_apply(dim, source, SPEC, "2026-03-02 00:00:00")
    assert rows(dim, "id", "is_current") == [(None, True), (None, True)]


def test_null_attributes_collide_without_a_token(spark):
    source = spark.createDataFrame([(1, None, "x", DAY), (2, "x", None, DAY)], DDL)
    hashes = [r["attribute_hash"] for r in attribute_hash(source, SPEC).collect()]
    assert hashes[0] == hashes[1]
    marked = Scd2Spec(**{**SPEC.__dict__, "null_token": "?"})
    hashes = [r["attribute_hash"] for r in attribute_hash(source, marked).collect()]
    assert hashes[0] != hashes[1]


def test_duplicate_source_keys_are_found(spark, rows):
    source = spark.createDataFrame([(1, "a", "x", DAY)] * 2 + [(None, "a", "x", DAY)] * 2, DDL)
    assert rows(duplicate_keys(source, ("id",))) == [(1, 2)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(source_state, min_size=1, max_size=3))
def test_history_property(spark, rows, states):
    dim, expected = empty(spark), {}
    for number, state in enumerate(states):
        stamp = f"2026-03-0{number + 1} 00:00:00"
        source = frame(spark, state)
        merged = scd2_merge(dim, scd2_changes(dim, source, SPEC, stamp), SPEC, stamp)
        dim = spark.createDataFrame(scd2_apply(dim, source, SPEC, stamp).collect(), dim.schema)
        assert rows(dim) == rows(merged)
        for key, value in state.items():
            text = [part for part in value if part is not None]
            if key not in expected or expected[key][-1] != text:
                expected.setdefault(key, []).append(text)
    versions = {}
    for r in sorted(dim.collect(), key=lambda r: r["record_start_ts"]):
        versions.setdefault(r["id"], []).append(r)
    assert {k: len(v) for k, v in versions.items()} == {k: len(v) for k, v in expected.items()}
    for history in versions.values():
        assert [r["is_current"] for r in history] == [False] * (len(history) - 1) + [True]
        for earlier, later in zip(history, history[1:]):
            assert earlier["record_end_ts"] == later["record_start_ts"]


def test_run_publishes_once_and_skips_an_unchanged_source(spark, layers, rows):
    silver, gold = layers.silver_table("src"), layers.gold_table("dim")
    publish_table(frame(spark, {1: ("a", "x")}), silver)
    assert run_scd2(spark, layers, [SPEC], datetime(2026, 3, 1)) == 1
    place = "select distinct regexp_extract(_metadata.file_path, '(.*)/', 1) p from " + gold
    before = rows(spark.sql(place))
    assert run_scd2(spark, layers, [SPEC], datetime(2026, 3, 2)) == 0
    assert rows(spark.sql(place)) == before
    publish_table(frame(spark, {1: ("b", "x")}), silver)
    assert run_scd2(spark, layers, [SPEC], datetime(2026, 3, 3)) == 1
    assert rows(spark.table(gold), "name", "is_current") == [("a", False), ("b", True)]
    log = spark.table(layers.metadata_table("pipeline_logs"))
    assert rows(log, "table_name", "rows_read", "rows_written", "status") == [
        ("dim", 0, 0, "SUCCESS"),
        ("dim", 1, 1, "SUCCESS"),
        ("dim", 1, 1, "SUCCESS"),
    ]


def test_run_rejects_repeated_keys_and_logs_the_failure(spark, layers, rows):
    repeated = spark.createDataFrame([(1, "a", "x", DAY), (1, "b", "x", DAY)], DDL)
    publish_table(repeated, layers.silver_table("src"))
    try:
        run_scd2(spark, layers, [SPEC], datetime(2026, 3, 1))
        raise AssertionError("repeated keys were accepted")
    except ValueError as error:
        assert "repeats keys" in str(error)
    log = spark.table(layers.metadata_table("pipeline_logs"))
    assert rows(log, "status", "rows_written") == [("FAILED", 0)]


def test_composite_key(spark, rows):
    spec = Scd2Spec("d", "s", ("a", "b"), ("v",), "sk")
    source = spark.createDataFrame([(1, 1, "x"), (1, None, "y")], "a int, b int, v string")
    dim = spark.createDataFrame([], dimension_schema(source.schema, spec))
    dim = scd2_apply(dim, source, spec, "2026-03-01 00:00:00")
    later = spark.createDataFrame([(1, 1, "z")], "a int, b int, v string")
    dim = scd2_apply(dim, later, spec, "2026-03-02 00:00:00")
    assert rows(dim, "b", "v", "is_current") == sorted(
        [(1, "x", False), (1, "z", True), (None, "y", True)], key=repr
    )


def test_apply_without_a_run_log(spark, layers):
    publish_table(frame(spark, {1: ("a", "x")}), layers.silver_table("src"))
    assert apply_scd2(spark, layers, SPEC, datetime(2026, 3, 1)) == 1
