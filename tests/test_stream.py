from __future__ import annotations

import os
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql.types import StructType

from siltstone.functions.derive import RESCUED
from siltstone.plans.control import RUN_LOG
from siltstone.specs import TableSpec
from siltstone.streaming.ingest import ingest_all, ingest_stream
from siltstone.streaming.schema import (
    NewColumnsError,
    file_schemas,
    guard_schema,
    pinned_schema,
    read_pinned,
    rescue,
)

SPEC = TableSpec("Items", "ts", ("id",), "ts", partition_by=("day",), last_batch_wins=True)
DDL = "id int, v string, ts timestamp, day int"


def at(minute):
    return datetime(2026, 3, 1, 10, minute)


def land_rows(spark, layers, data, name, ddl=DDL, spec=SPEC):
    spark.createDataFrame(data, ddl).write.mode("append").parquet(f"{layers.bronze(spec)}/{name}")


def log_of(spark, layers, rows):
    columns = ("rows_read", "rows_written", "status", "batch_id")
    return rows(spark.table(layers.metadata_table(RUN_LOG)), *columns)


def test_files_are_ingested_once_and_the_last_batch_wins(spark, layers, rows):
    table = layers.silver_table("Items")
    land_rows(spark, layers, [(1, "a", at(1), 1), (1, "b", at(2), 1), (2, "c", at(1), 2)], "one")
    ingest_stream(spark, SPEC, layers)
    assert rows(spark.table(table), "id", "v") == [(1, "b"), (2, "c")]
    ingest_stream(spark, SPEC, layers)
    assert log_of(spark, layers, rows) == [(3, 2, "SUCCESS", "0")]
    land_rows(spark, layers, [(1, "late", at(0), 2), (3, "d", at(5), 3)], "two")
    ingest_stream(spark, SPEC, layers)
    assert rows(spark.table(table), "id", "v", "day") == [(1, "late", 2), (2, "c", 2), (3, "d", 3)]
    assert log_of(spark, layers, rows) == [(2, 2, "SUCCESS", "1"), (3, 2, "SUCCESS", "0")]


def test_guarded_stream_keeps_the_newer_row(spark, layers, rows):
    spec = TableSpec("Items", "ts", ("id",), "ts")
    land_rows(spark, layers, [(1, "new", at(9), 1)], "one")
    ingest_stream(spark, spec, layers)
    land_rows(spark, layers, [(1, "late", at(0), 1)], "two")
    ingest_stream(spark, spec, layers)
    assert rows(spark.table(layers.silver_table("Items")), "v") == [("new",)]


@pytest.mark.parametrize("max_files", [1, 100])
def test_newest_row_wins_however_batches_are_cut(spark, layers, rows, max_files):
    spec = TableSpec("Items", "ts", ("id",), "ts", tie_breakers=("day",))
    for k, data in enumerate([[(1, "new", at(9), 1), (2, "a", at(1), 5)], [(1, "old", at(3), 9), (2, "z", at(1), 4)]]):
        land_rows(spark, layers, data, f"{k}", spec=spec)
    ingest_stream(spark, spec, layers, max_files=max_files)
    assert rows(spark.table(layers.silver_table("Items")), "id", "v") == [(1, "new"), (2, "a")]


def test_old_files_are_read(spark, layers, rows):
    spec = TableSpec("Items", "ts", ("id",), "ts")
    land_rows(spark, layers, [(1, "a", at(1), 1)], "one", spec=spec)
    ingest_stream(spark, spec, layers)
    land_rows(spark, layers, [(2, "b", at(1), 1)], "two", spec=spec)
    month_ago = time.time() - 30 * 86_400
    for file in Path(layers.bronze(spec), "two").iterdir():
        os.utime(file, (month_ago, month_ago))
    ingest_stream(spark, spec, layers)
    assert rows(spark.table(layers.silver_table("Items")), "id") == [(1,), (2,)]


def test_many_small_batches_equal_one_run(spark, layers, rows):
    data = [(i % 7, f"v{i}", at(i), i % 3) for i in range(20)]
    for part in range(4):
        land_rows(spark, layers, data[part * 5:part * 5 + 5], f"{part}")
        ingest_stream(spark, SPEC, layers, max_files=1)
    whole = TableSpec("Whole", "ts", ("id",), "ts")
    land_rows(spark, layers, data, "all", spec=whole)
    ingest_stream(spark, whole, layers)
    names = ("id", "v", "ts", "day")
    assert rows(spark.table(layers.silver_table("Items")), *names) == rows(
        spark.table(layers.silver_table("Whole")), *names
    )


def test_redelivered_rows_change_nothing(spark, layers, rows):
    table = layers.silver_table("Items")
    data = [(1, "a", at(1), 1), (2, "b", at(1), 2)]
    land_rows(spark, layers, data, "one")
    ingest_stream(spark, SPEC, layers)
    before = rows(spark.table(table))
    land_rows(spark, layers, data, "again")
    ingest_stream(spark, SPEC, layers)
    assert rows(spark.table(table)) == before


def test_empty_increment_keeps_the_snapshot(spark, layers, rows):
    land_rows(spark, layers, [(1, "a", at(1), 1)], "one")
    ingest_stream(spark, SPEC, layers)
    files = spark.table(layers.silver_table("Items")).inputFiles()
    land_rows(spark, layers, [], "none")
    ingest_stream(spark, SPEC, layers)
    assert spark.table(layers.silver_table("Items")).inputFiles() == files
    assert log_of(spark, layers, rows)[0] == (0, 0, "SUCCESS", "1")


def test_new_column_stops_the_stream_before_writing(spark, layers, rows):
    table = layers.silver_table("Items")
    land_rows(spark, layers, [(1, "a", at(1), 1)], "one")
    ingest_stream(spark, SPEC, layers)
    land_rows(spark, layers, [(2, "b", at(2), 1, "x")], "two", DDL + ", extra string")
    with pytest.raises(Exception, match="extra"):
        ingest_stream(spark, SPEC, layers)
    assert rows(spark.table(table), "id") == [(1,)]
    assert log_of(spark, layers, rows) == [(0, 0, "FAILED", "1"), (1, 1, "SUCCESS", "0")]
    with pytest.raises(Exception, match="extra"):
        ingest_all(spark, [SPEC, TableSpec("Never", "ts", ("id",), "ts")], layers)


def test_missing_column_becomes_null(spark, layers, rows):
    land_rows(spark, layers, [(1, "a", at(1), 1)], "one")
    ingest_stream(spark, SPEC, layers)
    land_rows(spark, layers, [(2, at(2), 1)], "two", "id int, ts timestamp, day int")
    ingest_stream(spark, SPEC, layers)
    assert rows(spark.table(layers.silver_table("Items")), "id", "v") == [(1, "a"), (2, None)]


def test_drifted_types_are_cast_and_the_rest_rescued(spark, tmp_path, rows):
    pinned = spark.createDataFrame([(1, 2)], "id int, n int")
    pinned.write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([(2, "7"), (3, "bad"), (4, None)], "id int, n string").write.parquet(f"{tmp_path}/b")
    spark.createDataFrame([(5, 8)], "id bigint, n int").write.parquet(f"{tmp_path}/c")
    paths = [f"{tmp_path}/{name}" for name in "abc"]
    assert len(file_schemas(spark, paths)) == 3
    got = read_pinned(spark, paths, pinned.schema)
    assert got.columns == ["id", "n", RESCUED]
    assert rows(got) == sorted(
        [(1, 2, None), (2, 7, None), (3, None, '{"n":"bad"}'), (4, None, None), (5, 8, None)], key=repr
    )


def test_drifted_file_in_a_stream(spark, layers, rows):
    land_rows(spark, layers, [(1, "a", at(1), 1)], "one")
    ingest_stream(spark, SPEC, layers)
    land_rows(spark, layers, [("2", "b", at(1), 1), ("x", "c", at(1), 1)], "two", DDL.replace("id int", "id string"))
    ingest_stream(spark, SPEC, layers)
    got = rows(spark.table(layers.silver_table("Items")), "id", "v")
    assert got == [(1, "a"), (2, "b"), (None, "c")]


def test_pinned_schema_is_read_back(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{tmp_path}/one")
    spark.createDataFrame([(1, 2)], "a int, b int").write.parquet(f"{tmp_path}/two")
    first = pinned_schema(spark, f"{tmp_path}/schema", [f"{tmp_path}/one"])
    assert first == pinned_schema(spark, f"{tmp_path}/schema", [f"{tmp_path}/two"])
    wider = spark.read.parquet(f"{tmp_path}/two").schema
    with pytest.raises(NewColumnsError) as caught:
        guard_schema(first, wider)
    assert caught.value.columns == ["b"]


def test_rescue_ignores_column_case(spark, rows):
    df = spark.createDataFrame([("1",)], "ID string")
    pinned = spark.createDataFrame([(1,)], "id int").schema
    assert rows(rescue(df, pinned)) == [(1, None)]


@pytest.mark.parametrize(
    "source, target, values, kept",
    [
        ("double", "int", [1.0, 1.9, None], [1, None, None]),
        ("timestamp", "date", [datetime(2026, 1, 2), datetime(2026, 1, 2, 3)], [datetime(2026, 1, 2).date(), None]),
        ("bigint", "double", [9007199254740992, 9007199254740993], [9007199254740992.0, None]),
        ("int", "float", [16777216, 16777217], [16777216.0, None]),
        ("string", "int", ["7", "07", "7.5", "x"], [7, 7, None, None]),
        ("string", "date", ["2026-01-02", "2026-01-02 03:00:00"], [datetime(2026, 1, 2).date(), None]),
    ],
)
def test_casts_that_lose_something_are_rescued(spark, source, target, values, kept):
    found = spark.createDataFrame([(v,) for v in values], f"v {source}")
    got = rescue(found, StructType.fromDDL(f"v {target}")).collect()
    assert [r.v for r in got] == kept
    assert [r[RESCUED] is not None for r in got] == [v is not None and k is None for v, k in zip(values, kept, strict=True)]


def test_alternating_types_cost_a_merge_per_folder(spark, tmp_path, monkeypatch):
    paths = []
    for k in range(8):
        spark.createDataFrame([(k, str(k))], "a int, b string").select(
            "a" if k % 2 else "b"
        ).toDF("v").coalesce(1).write.parquet(f"{tmp_path}/{k}")
        paths += [str(p) for p in Path(tmp_path, str(k)).glob("*.parquet")]
    merges = []
    reader = type(spark.read)
    parquet = reader.parquet
    monkeypatch.setattr(reader, "parquet", lambda self, *p, **o: merges.append(p) or parquet(self, *p, **o))
    groups = file_schemas(spark, paths)
    assert sorted(len(members) for _, members in groups) == [4, 4]
    assert len(merges) <= 1 + len(paths)
