from __future__ import annotations

import pytest

from siltstone.operators.joins import Lookup, join_chain, resolve_keys
from siltstone.plans.listening import STREAM_DETAIL_JOIN
from siltstone.specs import JoinSpec


def test_lookups_lose_no_row(spark, rows):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, k int")
    dim = spark.createDataFrame([(10, "x", 0), (None, "n", 0)], "k int, key string, unused int")
    got = resolve_keys(fact, [Lookup(dim, ("k",), ("key",))])
    assert rows(got, "id", "key") == [(1, "x"), (2, None), (3, None)]


def test_declared_join_from_plain_mappings(spark, rows):
    entries = [
        {"table": "fact", "alias": "f", "cols": "f.id, f.k"},
        {"table": "dim", "alias": "d", "cols": ["d.name", "upper(d.name) as shout"], "condition": "f.k = d.k"},
        {"table": "band", "alias": "b", "cols": "b.label", "condition": "f.id >= b.low AND f.id < b.high",
         "span": ["f.id", "b.low", "b.high", 3]},
    ]
    tables = {
        "fact": spark.createDataFrame([(1, 10), (7, 20)], "id int, k int"),
        "dim": spark.createDataFrame([(10, "x")], "k int, name string"),
        "band": spark.createDataFrame([(0, 5, "small"), (5, 9, "big")], "low int, high int, label string"),
    }
    got = join_chain(tables.__getitem__, [JoinSpec.of(e) for e in entries])
    assert got.columns == ["id", "k", "name", "shout", "label"]
    assert rows(got) == [(1, 10, "x", "X", "small"), (7, 20, None, None, "big")]
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_declared_join_rejects_unusable_specs(spark):
    table = spark.createDataFrame([(1,)], "id int")
    base = JoinSpec("t", "a", ("a.id",))
    with pytest.raises(ValueError, match="repeated"):
        join_chain(lambda _: table, [base, JoinSpec("t", "b", ("b.id",), "a.id = b.id")])
    with pytest.raises(ValueError, match="condition"):
        join_chain(lambda _: table, [base, JoinSpec("t", "b", ("b.id as other",))])
    with pytest.raises(ValueError, match="base"):
        join_chain(lambda _: table, [])
    with pytest.raises(ValueError, match="list"):
        JoinSpec.of({"table": "t", "alias": "a", "cols": "concat(a.x, a.y)"})


def test_default_declared_join_columns(spark):
    ddl = {
        "FactStream": "stream_id bigint, listen_duration int, user_id int, track_id int",
        "DimUser": "user_id int, user_name string",
        "DimTrack": "track_id int, track_name string",
    }
    got = join_chain(lambda name: spark.createDataFrame([], ddl[name]), STREAM_DETAIL_JOIN)
    assert got.columns == [
        "stream_id", "listen_duration", "user_id", "user_name", "track_id", "track_name",
    ]


def test_conditions_are_left_to_spark(spark, rows):
    tables = {
        "f": spark.createDataFrame([(1, 5, "x or y"), (2, 1, "z"), (3, 1, None)], "k int, a int, s string"),
        "t": spark.createDataFrame([(1, 9), (2, 1), (2, 7)], "k int, b int"),
    }
    base, cols = JoinSpec("f", "f", ("f.k",)), ("t.b",)
    for spec, expected in (
        (JoinSpec("t", "t", cols, "f.a > 4 OR t.b < 2", on=(("f.k", "t.k"),)), [(1, 9), (2, 1), (3, None)]),
        (JoinSpec("t", "t", cols, "f.k = t.k AND (f.a > 4 OR t.b < 2)"), [(1, 9), (2, 1), (3, None)]),
        (JoinSpec("t", "t", cols, "f.s = 'x or y'", on=(("f.k", "t.k"),)), [(1, 9), (2, None), (3, None)]),
        (JoinSpec.of({"table": "t", "alias": "t", "cols": "t.b", "on": [["f.k + 1", "t.k"]]}), [(1, 1), (1, 7), (2, None), (3, None)]),
    ):
        got = join_chain(tables.__getitem__, [base, spec])
        assert rows(got) == expected
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
