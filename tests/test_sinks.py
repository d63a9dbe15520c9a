from __future__ import annotations

from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.operators.expectations import Expectation, ExpectationError, require, violations
from siltstone.operators.keyed import INCOMING, newer_than_stored, upsert, upsert_newest
from siltstone.plans.control import OPERATIONS
from siltstone.sinks.ledger import Ledger
from siltstone.sinks.logs import (
    RUN_LOG_DDL,
    RunEntry,
    failure_alerts,
    failure_windows,
    log_checks,
    log_run,
    newest_first,
    recent_runs,
)
from siltstone.sinks.publish import (
    create_table,
    new_snapshot_path,
    partition_filter,
    publish_table,
    swap_partitions,
    sweep_snapshots,
    table_partitions,
    write_snapshot,
)
from siltstone.sinks.upsert import Merged, upsert_table
from siltstone.sources import incremental
from siltstone.specs import TableSpec

DDL = "id int, v string, day date, y int"
POSITIVE = Expectation("id_positive", "id > 0")


def day(n):
    return None if n is None else date(2026, 3, n)


def frame(spark, data):
    return spark.createDataFrame(data, DDL)


def test_publish_replaces_and_creates(spark, layers, rows):
    table = layers.gold_table("t")
    publish_table(frame(spark, [(1, "a", day(1), 2026)]), table)
    done = publish_table(
        frame(spark, [(2, "b", day(1), 2026), (3, None, None, None)]), table,
        metrics={"top": F.max("id")},
    )
    assert (done.rows, done.metrics["top"]) == (2, 3)
    assert rows(spark.table(table), "id") == [(2,), (3,)]


def test_publish_may_read_the_table_it_replaces(spark, layers, rows):
    table = layers.gold_table("t")
    publish_table(frame(spark, [(1, "a", day(1), 2026)]), table)
    publish_table(spark.table(table).withColumn("v", F.lit("z")), table)
    assert rows(spark.table(table), "v") == [("z",)]


def test_publish_of_nothing(spark, layers, rows):
    table = layers.gold_table("t")
    assert publish_table(frame(spark, []), table).rows == 0
    assert publish_table(frame(spark, []).limit(0), table, metrics={"m": F.max("id")}).rows == 0
    assert spark.table(table).count() == 0


def test_publish_with_other_columns_declares_the_table_anew(spark, layers, rows):
    table, parted = layers.gold_table("t"), layers.gold_table("p")
    for name, parts in ((table, []), (parted, ["y"])):
        publish_table(frame(spark, [(1, "a", day(1), 2026)]), name, parts)
        publish_table(frame(spark, [(2, "b", day(1), 2027)]).withColumn("more", F.lit(1)), name, parts)
        assert rows(spark.table(name), "id", "more", "y") == [(2, 1, 2027)]


def test_columns_without_nulls_may_get_some_later(spark, layers, rows):
    table = layers.gold_table("t")
    publish_table(spark.range(2).withColumn("flag", F.lit(True)), table)
    publish_table(spark.sql("select 5L as id, cast(null as boolean) as flag"), table)
    assert spark.table(table).filter("flag is null").count() == 1


def test_broken_expectation_leaves_the_table_alone(spark, layers, rows):
    table = layers.gold_table("t")
    good = frame(spark, [(1, "a", day(1), 2026)])
    publish_table(good, table, expectations=[POSITIVE])
    bad = frame(spark, [(0, "b", day(1), 2026), (None, "c", day(1), 2026), (5, "d", None, 1)])
    checks = [POSITIVE, Expectation("v_known", "v IN ('a', 'b', 'c', 'd')")]
    with pytest.raises(ExpectationError) as caught:
        publish_table(bad, table, expectations=checks)
    assert caught.value.violations == {"id_positive": 2}
    assert rows(spark.table(table), "id") == [(1,)]
    assert rows(violations(bad, checks)) == [("id_positive", 2), ("v_known", 0)]
    assert rows(require(good, checks)) == rows(good)
    with pytest.raises(Exception, match="id_positive"):
        require(bad, checks).select("v").count()


def test_partitioned_publish_replaces_partitions(spark, layers, rows):
    table = layers.gold_table("t")
    publish_table(
        frame(spark, [(1, "a", day(1), 2026), (2, "b", day(2), 2026), (3, "c", None, None)]),
        table, ["y", "day"],
    )
    assert table_partitions(spark, table) == {
        ("2026", "2026-03-01"), ("2026", "2026-03-02"), (None, None),
    }
    publish_table(
        frame(spark, [(9, "z", day(2), 2026), (8, "n", None, 2026)]), table, ["y", "day"]
    )
    assert table_partitions(spark, table) == {("2026", "2026-03-02"), ("2026", None)}
    assert rows(spark.table(table), "id", "day") == [(8, None), (9, day(2))]


def test_partition_values_with_odd_characters(spark, layers, rows):
    table = layers.gold_table("t")
    names = ["it's", "a/b=c", "100% x", "back\\slash", "plus+ sign", "ü:ö"]
    data = [(i, name) for i, name in enumerate(names)]
    publish_table(spark.createDataFrame(data, "id int, p string"), table, ["p"])
    publish_table(spark.createDataFrame(data[:3], "id int, p string"), table, ["p"])
    upsert_table(spark.createDataFrame([(1, "it's"), (7, "new: one")], "id int, p string"), table, ["id"], ["p"])
    assert rows(spark.table(table), "id", "p") == [
        (0, "it's"), (1, "it's"), (2, "100% x"), (7, "new: one"),
    ]


def test_empty_text_lands_in_the_null_partition(spark, layers, rows):
    table = layers.gold_table("t")
    ddl = "id int, p string"
    upsert_table(spark.createDataFrame([(1, ""), (2, None), (3, "x")], ddl), table, ["id"], ["p"])
    batch = spark.createDataFrame([(1, "x"), (4, "")], ddl)
    assert upsert_table(batch, table, ["id"], ["p"]) == Merged(1, 1)
    assert rows(spark.table(table)) == [(1, "x"), (2, None), (3, "x"), (4, None)]


def test_partition_filter_prunes(spark, layers):
    table = layers.gold_table("t")
    publish_table(
        frame(spark, [(n, "a", day(n), 2026 if n < 3 else None) for n in range(1, 6)]), table, ["y", "day"]
    )
    df = spark.table(table)
    keys = {("2026", "2026-03-01"), (None, "2026-03-04"), (None, None)}
    kept = df.filter(partition_filter(df.schema, ["y", "day"], keys))
    assert sorted(r["id"] for r in kept.collect()) == [1, 4]
    assert len(kept.inputFiles()) == 2


def test_upsert_counts_and_moves_between_partitions(spark, layers, rows):
    table = layers.silver_table("t")
    first = frame(spark, [(1, "a", day(1), 1), (2, "b", day(2), 1), (3, "c", day(3), 1), (None, "n", day(3), 1)])
    assert upsert_table(first, table, ["id"], ["day"]) == Merged(4, 0)
    untouched = {f for f in spark.table(table).inputFiles() if "day=2026-03-03" in f}
    second = frame(spark, [(1, "a2", day(2), 1), (4, "d", None, 1)])
    assert upsert_table(second, table, ["id"], ["day"]) == Merged(1, 1)
    want = sorted(
        [(1, "a2", day(2)), (2, "b", day(2)), (3, "c", day(3)), (4, "d", None), (None, "n", day(3))],
        key=repr,
    )
    assert rows(spark.table(table), "id", "v", "day") == want
    assert untouched <= set(spark.table(table).inputFiles())
    assert ("2026-03-01",) not in table_partitions(spark, table)
    assert upsert_table(second, table, ["id"], ["day"]) == Merged(0, 2)
    assert rows(spark.table(table), "id", "v", "day") == want


def test_stable_partitions_promise_skips_other_partitions(spark, layers, rows):
    table = layers.silver_table("t")
    upsert_table(frame(spark, [(1, "a", day(1), 1), (2, "b", day(2), 1)]), table, ["id"], ["day"])
    again = frame(spark, [(1, "x", day(1), 1)])
    assert upsert_table(again, table, ["id"], ["day"], stable_partitions=True) == Merged(0, 1)
    assert rows(spark.table(table), "id", "v") == [(1, "x"), (2, "b")]


def test_guarded_table_upsert(spark, layers, rows):
    table = layers.silver_table("t")
    upsert_table(frame(spark, [(1, "a", day(5), 1), (2, "b", day(5), 1)]), table, ["id"])
    batch = frame(spark, [(1, "older", day(4), 1), (2, "newer", day(6), 1)])
    assert upsert_table(batch, table, ["id"], guard_order="day") == Merged(0, 1)
    assert rows(spark.table(table), "id", "v") == [(1, "a"), (2, "newer")]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.dictionaries(st.integers(0, 5), st.tuples(st.sampled_from("ab"), st.sampled_from([None, 1, 2]))),
        min_size=1, max_size=3,
    )
)
def test_partitioned_upserts_fold_like_a_dictionary(spark, layers, rows, batches):
    table = layers.silver_table(f"t{abs(hash(repr(batches)))}")
    state = {}
    for batch in batches:
        upsert_table(
            frame(spark, [(k, v, day(n), 1) for k, (v, n) in batch.items()]), table, ["id"], ["day"]
        )
        state.update(batch)
    assert rows(spark.table(table), "id", "v", "day") == sorted(
        [(k, v, day(n)) for k, (v, n) in state.items()], key=repr
    )


def test_partitions_not_read_before_are_never_overwritten(spark, layers, rows):
    table = layers.silver_table("t")
    upsert_table(frame(spark, [(1, "a", day(1), 1), (2, "b", day(2), 1)]), table, ["id"], ["day"])
    done = write_snapshot(frame(spark, [(9, "z", day(2), 1)]), new_snapshot_path(spark, table), ["day"])
    with pytest.raises(RuntimeError, match="not read before"):
        swap_partitions(spark, table, ["day"], done.location, {("2026-03-01",)})
    assert rows(spark.table(table), "id") == [(1,), (2,)]


def test_sweep_deletes_only_former_snapshots(spark, layers, rows):
    plain, parted = layers.gold_table("plain"), layers.gold_table("parted")
    for n in (1, 2, 3):
        publish_table(frame(spark, [(n, "a", day(n), 1)]), plain)
        upsert_table(frame(spark, [(1, f"v{n}", day(1), 1), (n + 1, "x y", None, 1)]), parted, ["id"], ["day"])
    assert sweep_snapshots(spark, plain) == sweep_snapshots(spark, parted, ["day"]) == []
    assert len(sweep_snapshots(spark, plain, min_age_hours=-1)) == 2
    assert len(sweep_snapshots(spark, parted, ["day"], min_age_hours=-1)) == 4
    spark.catalog.refreshTable(plain)
    assert rows(spark.table(plain), "id") == [(3,)]
    assert rows(spark.table(parted), "id", "v") == [(1, "v3"), (2, "x y"), (3, "x y"), (4, "x y")]
    odd = layers.gold_table("odd")
    for n in (1, 2):
        publish_table(spark.createDataFrame([(n, "a/b: 100% c'd")], "id int, p string"), odd, ["p"])
    assert len(sweep_snapshots(spark, odd, ["p"], min_age_hours=-1)) == 1
    assert rows(spark.table(odd), "id") == [(2,)]


def test_create_table_if_absent(spark, layers):
    table = layers.gold_table("t")
    create_table(spark, table, "a int NOT NULL, b string")
    create_table(spark, table, "other int")
    assert spark.table(table).columns == ["a", "b"]
    create_table(spark, table, "other int", replace=True)
    assert spark.table(table).columns == ["other"]


def test_logs(spark, layers, rows):
    log = layers.metadata_table("pipeline_logs")
    for minute, status in ((0, "FAILED"), (3, "FAILED"), (4, "SUCCESS"), (7, "FAILED")):
        entry = RunEntry("n", "t", 5, 4, 1.5, status, "boom" if status == "FAILED" else None, str(minute))
        log_run(spark, log, entry, datetime(2026, 3, 1, 10, minute))
    runs = spark.table(log)
    assert [r["batch_id"] for r in recent_runs(runs, 2).collect()] == ["7", "4"]
    assert [r["batch_id"] for r in newest_first(runs, "event_timestamp").collect()] == ["7", "4", "3", "0"]
    assert rows(failure_windows(runs), "window_start", "failed_runs") == [
        (datetime(2026, 3, 1, 10, 0), 2), (datetime(2026, 3, 1, 10, 5), 1),
    ]
    assert rows(failure_windows(runs, threshold=1), "failed_runs") == [(2,)]
    checks = spark.createDataFrame([("t", "c", "PASS", "d")], "table_name string, check_name string, status string, details string").collect()
    log_checks(spark, layers.metadata_table("data_quality_log"), checks)
    log_checks(spark, layers.metadata_table("data_quality_log"), [])
    assert spark.table(layers.metadata_table("data_quality_log")).count() == 1


def test_streamed_failure_windows(spark, tmp_path, rows):
    data = [(datetime(2026, 3, 1, 10, m), "FAILED") for m in (0, 1, 6, 30)]
    log = spark.createDataFrame(data, "event_timestamp timestamp, status string")
    log.write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "log"))
    seen = []
    query = (
        failure_windows(stream, watermark="10 minutes")
        .writeStream.outputMode("append")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .foreachBatch(lambda df, _: seen.extend(tuple(r) for r in df.collect()))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted((w.minute, n) for w, _, n in seen) == [(0, 2), (5, 1)]
    assert RUN_LOG_DDL.count(",") == 9


def test_upsert_names_columns_the_table_lacks(spark, layers):
    table = layers.silver_table("t")
    upsert_table(frame(spark, [(1, "a", day(5), 1)]), table, ["id"])
    with pytest.raises(ValueError, match="extra"):
        upsert_table(frame(spark, [(1, "a", day(5), 1)]).withColumn("extra", F.lit(1)), table, ["id"])


def test_an_added_column_keeps_the_old_snapshot_readable(spark, layers, rows):
    table = layers.silver_table("t")
    publish_table(spark.createDataFrame([(1,)], "id int"), table)
    before = spark.table(table)
    files = before.inputFiles()
    publish_table(spark.createDataFrame([(1, "x")], "id int, v string"), table)
    assert rows(spark.table(table)) == [(1, "x")]
    assert rows(spark.read.parquet(*files)) == [(1,)]
    publish_table(spark.createDataFrame([("y",)], "v string"), table)
    assert rows(spark.table(table)) == [("y",)]
    assert rows(spark.read.parquet(*files)) == [(1,)]


def test_alerts_are_raised_once(spark, tmp_path, rows):
    """Late rows complete a window, and later ones do not raise its alert again."""
    ddl = "event_timestamp timestamp, status string"
    log, seen = str(tmp_path / "log"), []

    def run(minutes):
        spark.createDataFrame([(datetime(2026, 3, 1, 10, m), s) for m, s in minutes], ddl).write.mode("append").parquet(log)
        query = (
            failure_alerts(spark.readStream.schema(ddl).parquet(log), threshold=1, keep="2 hours")
            .writeStream.outputMode("append")
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .foreachBatch(lambda df, _: seen.extend((r["window_start"].minute, r["window_end"].minute) for r in df.collect()))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    run([(0, "FAILED"), (1, "SUCCESS"), (7, "FAILED")])
    assert seen == []
    run([(40, "FAILED"), (2, "FAILED"), (41, "FAILED"), (42, "FAILED")])
    assert sorted(seen) == [(0, 5), (40, 45)]
    run([(3, "FAILED"), (4, "FAILED"), (8, "FAILED"), (43, "FAILED")])
    assert sorted(seen) == [(0, 5), (5, 10), (40, 45)]


def test_guarded_upsert_of_a_whole_table_is_one_shuffle(spark):
    stored = spark.range(100).select("id", F.lit("s").alias("v"), F.lit(1).alias("y"))
    batch = spark.range(50, 150).select("id", F.lit("b").alias("v"), F.lit(2).alias("y"))
    state = upsert_newest(stored, batch, ["id"], ["y"])
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert state.filter("v = 'b'").count() == 100 and state.count() == 150


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(*[st.lists(st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from("ab"), st.sampled_from([None, 1, 2])))] * 2)
def test_newest_in_one_pass_is_guard_then_upsert(spark, rows, stored, incoming):
    ddl = "id int, v string, y int"
    target = spark.createDataFrame([(i, v + "s", y) for i, v, y in stored], ddl)
    batch = spark.createDataFrame([(i, v + "b", y) for i, v, y in incoming], ddl)
    want = upsert(target, newer_than_stored(target, batch, ["id"], ["y"]), ["id"])
    got = upsert_newest(target, batch, ["id"], ["y"]).drop(INCOMING)
    assert rows(got, "id", "v", "y") == rows(want, "id", "v", "y")


def test_guarded_upsert_that_passes_nothing_leaves_the_table(spark, layers, rows):
    table, ledger = layers.silver_table("t"), Ledger(spark, layers.metadata_table(OPERATIONS))
    upsert_table(frame(spark, [(1, "a", day(5), 1)]), table, ["id"], ledger=ledger)
    files = spark.table(table).inputFiles()
    older = frame(spark, [(1, "older", day(4), 1)])
    assert upsert_table(older, table, ["id"], guard_order="day", ledger=ledger) == Merged(0, 0)
    assert spark.table(table).inputFiles() == files and ledger.version(table) == 1
    mixed = frame(spark, [(1, "same", day(5), 1), (None, "n", day(1), 1), (2, "b", None, 1)])
    assert upsert_table(mixed, table, ["id"], guard_order="day", ledger=ledger) == Merged(2, 1)
    assert rows(spark.table(table), "id", "v") == [(1, "same"), (2, "b"), (None, "n")]


def test_a_landed_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "LANDED_ROW_GROUP", 1 << 16)
    spec = TableSpec("t", "id", ("id",), "id")
    done = incremental.land(spark.range(100_000).coalesce(1), str(tmp_path), spec)
    (file,) = spark.read.parquet(done.location).inputFiles()
    assert pq.ParquetFile(file.removeprefix("file://")).num_row_groups > 1
