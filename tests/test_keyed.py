from __future__ import annotations

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.operators.keyed import (
    insert_absent,
    latest_per_key,
    merge_metrics,
    newer_than_stored,
    update_matched,
    upsert,
)

DDL = "k int, ts int, v string"
QUICK = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
row = st.tuples(
    st.one_of(st.none(), st.integers(0, 4)),
    st.one_of(st.none(), st.integers(0, 3)),
    st.sampled_from("abc"),
)


def order(r):
    return (r[1] is not None, r[1] or 0, r[2])


def expected_latest(data):
    best = {}
    for r in data:
        if r[0] not in best or order(r) > order(best[r[0]]):
            best[r[0]] = r
    return sorted(best.values(), key=repr)


def test_latest_breaks_ties_and_keeps_one_null_key(spark, rows):
    data = [(1, 5, "a"), (1, 5, "b"), (1, None, "z"), (None, 1, "x"), (None, 2, "y"), (2, None, "q")]
    got = latest_per_key(spark.createDataFrame(data, DDL), ["k"], "ts")
    assert rows(got) == expected_latest(data)
    assert latest_per_key(spark.createDataFrame(data, DDL), [], "ts").count() == len(data)


def test_latest_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a")], DDL)
    plan = latest_per_key(df, ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_latest_with_one_key_holding_a_third(spark):
    data = [(0 if i % 3 == 0 else i, i, "v") for i in range(3000)]
    random.Random(1).shuffle(data)
    got = latest_per_key(spark.createDataFrame(data, DDL).repartition(8), ["k"], "ts")
    assert sorted(map(tuple, got.collect()), key=repr) == expected_latest(data)


@QUICK
@given(st.lists(row, max_size=20))
def test_latest_property(spark, rows, data):
    got = latest_per_key(spark.createDataFrame(data, DDL), ["k"], "ts")
    assert rows(got) == expected_latest(data)


def by_key(target, batch):
    keyed = {r[0]: r for r in target if r[0] is not None}
    keyed.update({r[0]: r for r in batch if r[0] is not None})
    loose = [r for r in [*target, *batch] if r[0] is None]
    return sorted([*keyed.values(), *loose], key=repr)


@QUICK
@given(st.lists(row, max_size=12), st.lists(row, max_size=12))
def test_upsert_property(spark, rows, stored, incoming):
    stored, incoming = expected_latest(stored), expected_latest(incoming)
    target, batch = spark.createDataFrame(stored, DDL), spark.createDataFrame(incoming, DDL)
    once = upsert(target, batch, ["k"])
    assert rows(once) == by_key(stored, incoming)
    keyed = batch.filter("k is not null")
    assert rows(upsert(upsert(target, keyed, ["k"]), keyed, ["k"])) == rows(
        upsert(target, keyed, ["k"])
    )
    known = {r[0] for r in stored} - {None}
    updated = sum(r[0] in known for r in incoming)
    assert rows(merge_metrics(target, batch, ["k"])) == [
        (len(incoming) - updated, updated, len(incoming))
    ]


def test_guard_keeps_the_newer_row(spark, rows):
    target = spark.createDataFrame([(1, 5, "old"), (2, 5, "old"), (3, None, "old"), (4, 1, "old")], DDL)
    batch = spark.createDataFrame([(1, 4, "new"), (2, 5, "new"), (3, 0, "new"), (4, None, "new"), (5, 1, "new")], DDL)
    got = upsert(target, newer_than_stored(target, batch, ["k"], "ts"), ["k"])
    assert rows(got, "k", "v") == [(1, "old"), (2, "new"), (3, "new"), (4, "old"), (5, "new")]


def test_guard_ordered_by_a_key_column(spark, rows):
    target = spark.createDataFrame([(1, 5, "old")], DDL)
    batch = spark.createDataFrame([(1, 5, "new")], DDL)
    assert rows(newer_than_stored(target, batch, ["k", "ts"], "ts")) == [(1, 5, "new")]


def test_insert_absent_leaves_known_rows(spark, rows):
    target = spark.createDataFrame([(1, 1, "a")], DDL)
    batch = spark.createDataFrame([(1, 9, "x"), (2, 9, "y"), (None, 9, "z")], DDL)
    assert rows(insert_absent(target, batch, ["k"])) == [(1, 1, "a"), (2, 9, "y"), (None, 9, "z")]


def test_update_matched_only_where_the_condition_holds(spark, rows):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "a"), (None, 1, "a")], DDL)
    keys = spark.createDataFrame([(1,), (None,)], "k int")
    got = update_matched(target, keys, ["k"], {"v": F.lit("X")}, F.col("ts") == 1)
    assert rows(got) == [(1, 1, "X"), (1, 2, "b"), (2, 1, "a"), (None, 1, "a")]
