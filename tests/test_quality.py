from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siltstone.operators.quality import (
    foreign_key_checks,
    merged_profiles,
    orphans,
    partition_profiles,
    pk_null_checks,
    profiles,
    row_drift_checks,
    run_checks,
    with_previous_counts,
)
from siltstone.plans.control import OPERATIONS, PROFILES, bootstrap, record_table_sizes
from siltstone.plans.profiles import changed_profiles, current_profiles
from siltstone.plans.runs import QualityError, run_quality
from siltstone.sinks.ledger import Ledger
from siltstone.sinks.publish import publish_table
from siltstone.sinks.upsert import upsert_table
from siltstone.specs import ForeignKey, TableSpec


def ids(spark, values, name="id"):
    return spark.createDataFrame([(v,) for v in values], f"{name} int")


def test_null_rates(spark, rows):
    tables = {"T": ids(spark, [1, None, 2]), "E": ids(spark, [])}
    got = rows(pk_null_checks(profiles(tables, {"T": ("id",), "E": ("id",)})))
    assert got == [
        ("E", "pk_null_rate_id", "PASS", "column=id, null_rows=0, total_rows=0, null_rate=0.0%"),
        ("T", "pk_null_rate_id", "FAIL", "column=id, null_rows=1, total_rows=3, null_rate=33.3333%"),
    ]


@pytest.mark.parametrize(
    "current, previous, status, details",
    [
        (15, 10, "PASS", "current_count=15, previous_count=10, delta_pct=50.0"),
        (5, 10, "PASS", "current_count=5, previous_count=10, delta_pct=50.0"),
        (16, 10, "WARNING", "current_count=16, previous_count=10, delta_pct=60.0"),
        (4, 3, "PASS", "current_count=4, previous_count=3, delta_pct=33.33"),
        (4, 0, "PASS", "current_count=4, previous_count=0"),
        (4, None, "PASS", "current_count=4, previous_count=None"),
        (0, 4, "WARNING", "current_count=0, previous_count=4, delta_pct=100.0"),
    ],
)
def test_drift(spark, rows, current, previous, status, details):
    marks = spark.createDataFrame([("T", previous)], "table_name string, n bigint")
    measured = profiles({"T": ids(spark, range(current))}, {"T": ("id",)})
    got = rows(row_drift_checks(with_previous_counts(measured, marks, "n")))
    assert got == [("T", "row_count_delta_check", status, details)]


def test_a_table_without_keys_or_watermark_still_gets_a_drift_check(spark, rows):
    marks = spark.createDataFrame([], "table_name string, n bigint")
    got = run_checks({"T": ids(spark, [1])}.__getitem__, {"T": ()}, [], marks, "n")
    assert rows(got, "check_name", "details") == [
        ("row_count_delta_check", "current_count=1, previous_count=None")
    ]


def test_orphans_are_distinct_and_include_null(spark, rows):
    key = ForeignKey("C", "pid", "P", "id")
    tables = {"C": ids(spark, [1, 1, 9, 9, 9, None, None], "pid"), "P": ids(spark, [1, 1, 2, None])}
    assert rows(orphans(tables["C"], tables["P"], key)) == [(9,), (None,)]
    assert rows(foreign_key_checks(tables.__getitem__, [key])) == [
        ("C", "referential_integrity_pid", "FAIL", "orphan_pids=2")
    ]


def test_hot_orphan_key_is_reduced_before_the_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = orphans(ids(spark, [1] * 100, "pid"), ids(spark, [2]), ForeignKey("C", "pid", "P", "id"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.index("LeftAnti") < plan.index("HashAggregate")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_run_logs_everything_and_then_fails(spark, layers, rows):
    child = TableSpec("C", "id", ("id",), "id")
    parent = TableSpec("P", "id", ("id",), "id")
    keys = [ForeignKey("C", "id", "P")]
    publish_table(ids(spark, [1, 2]), layers.silver_table("P"))
    publish_table(ids(spark, [1, None]), layers.silver_table("C"))
    with pytest.raises(QualityError) as caught:
        run_quality(spark, layers, [child, parent], keys)
    assert caught.value.samples == {"C.id": [None]}
    log = spark.table(layers.metadata_table("data_quality_log"))
    assert rows(log, "table_name", "check_name", "status") == [
        ("C", "pk_null_rate_id", "FAIL"),
        ("C", "referential_integrity_id", "FAIL"),
        ("C", "row_count_delta_check", "PASS"),
        ("P", "pk_null_rate_id", "PASS"),
        ("P", "row_count_delta_check", "PASS"),
    ]
    assert log.select("check_timestamp").distinct().count() == 1
    assert len(caught.value.failed) == 2


def test_warning_does_not_fail(spark, layers, rows):
    spec = TableSpec("T", "id", ("id",), "id")
    bootstrap(spark, layers, [spec])
    publish_table(ids(spark, [1, 2, 3]), layers.silver_table("T"))
    record_table_sizes(spark, layers, {"T": 1})
    checks = run_quality(spark, layers, [spec], [])
    assert [c["status"] for c in checks] == ["PASS", "WARNING"]


def kept(spark, layers, tables, keys, rows):
    measured = current_profiles(spark, layers, tables, keys)
    return rows(measured.select("table_name", "total_rows", F.transform("key_nulls", lambda e: F.concat_ws("=", e["column"], e["null_rows"]))))


def test_kept_profiles_follow_the_table(spark, layers, rows):
    ledger = Ledger(spark, layers.metadata_table(OPERATIONS))
    tables = {"T": layers.silver_table("t"), "U": layers.silver_table("u")}
    keys = {"T": ("id", "k"), "U": ()}
    ddl = "id int, k string, day int"
    batch = spark.createDataFrame([(1, None, 1), (2, "b", 2), (3, "", None), (None, "x", 2)], ddl)
    upsert_table(batch, tables["T"], ["id"], ["day"], ledger=ledger)
    publish_table(ids(spark, [1, 2]), tables["U"])
    assert kept(spark, layers, tables, keys, rows) == [("T", 4, ["id=1", "k=1"]), ("U", 2, [])]
    state = spark.table(layers.metadata_table(PROFILES))
    assert changed_profiles(spark, layers, "T", tables["T"], keys["T"], 1) is None

    # A row moves from the second day to the first, a day goes, and a new one comes.
    upsert_table(spark.createDataFrame([(2, None, 1), (3, "c", 4)], ddl), tables["T"], ["id"], ["day"], ledger=ledger)
    change = changed_profiles(spark, layers, "T", tables["T"], keys["T"], 2)
    named = {r["partition_key"]: r["total_rows"] for r in change.collect()}
    assert named == {'{"day":"1"}': 2, '{"day":"2"}': 1, '{"day":null}': 0, '{"day":"4"}': 1, "": 0}
    assert kept(spark, layers, tables, keys, rows) == [("T", 4, ["id=1", "k=2"]), ("U", 2, [])]
    state = spark.table(layers.metadata_table(PROFILES)).filter("table_name = 'T'")
    one = merged_profiles(state).first()
    assert [(e["column"], e["distinct_keys"]) for e in one["key_nulls"]] == [("id", 3), ("k", 2)]

    # Other keys, and a table replaced whole, are profiled whole.
    assert kept(spark, layers, tables, {"T": ("day",), "U": ()}, rows)[0] == ("T", 4, ["day=0"])
    publish_table(spark.createDataFrame([(9, "z", 5)], ddl), tables["T"], ["day"], ledger=ledger)
    assert kept(spark, layers, tables, keys, rows)[0] == ("T", 1, ["id=0", "k=0"])
    publish_table(spark.createDataFrame([], ddl), tables["T"], ["day"], ledger=ledger)
    assert kept(spark, layers, tables, keys, rows)[0] == ("T", 0, ["id=0", "k=0"])


def test_only_partitions_written_since_are_read(spark, layers, monkeypatch):
    ledger, table = Ledger(spark, layers.metadata_table(OPERATIONS)), layers.silver_table("t")
    ddl = "id int, day int"
    upsert_table(spark.createDataFrame([(k, k % 5) for k in range(50)], ddl), table, ["id"], ["day"], ledger=ledger)
    current_profiles(spark, layers, {"T": table}, {"T": ("id",)})
    upsert_table(spark.createDataFrame([(3, 3)], ddl), table, ["id"], ["day"], ledger=ledger)
    seen = []

    def watched(df, *rest):
        seen.extend(df.inputFiles())
        return partition_profiles(df, *rest)

    monkeypatch.setattr("siltstone.plans.profiles.partition_profiles", watched)
    current_profiles(spark, layers, {"T": table}, {"T": ("id",)})
    assert seen and all("/day=3/" in file for file in seen)
