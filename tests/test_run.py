"""A full run over the seed rows, then a second one after changes at the source."""

from __future__ import annotations

import hashlib
from datetime import date, datetime

import pytest

from siltstone.operators.expectations import ExpectationError
from siltstone.operators.joins import join_chain
from siltstone.plans.control import WATERMARKS
from siltstone.plans.listening import (
    DIMENSIONS,
    FACT_COLUMNS,
    FOREIGN_KEYS,
    MORE_FOREIGN_KEYS,
    SOURCE_DDL,
    STREAM_DETAIL_JOIN,
    TABLES,
    VIEWS,
)
from siltstone.plans.runs import run_all, run_quality
from siltstone.sources.incremental import ParquetSource
from siltstone.sources.tables import inline_rows, list_tables, preview, table_exists, temp_view


def ts(text):
    return datetime.fromisoformat(text)


def d(text):
    return date.fromisoformat(text)


# The seed rows of the source tables.
SEEDS = {
    "DimUser": [
        (1, "Carlos Berry", "Switzerland", "Premium", d("2023-10-17"), None, ts("2026-03-01T10:00:00")),
        (2, "Amanda Jenkins", "Montserrat", "Family", d("2024-09-28"), None, ts("2026-03-01T10:05:00")),
        (3, "Daniel Cook", "Chile", "Premium", d("2025-07-07"), None, ts("2026-03-01T10:10:00")),
        (4, "Peter Hernandez", "Nigeria", "Free", d("2024-07-16"), None, ts("2026-03-01T10:15:00")),
        (5, "Yolanda Morris", "Aruba", "Premium", d("2025-05-12"), None, ts("2026-03-01T10:20:00")),
    ],
    "DimArtist": [
        (1, "Lisa Jackson", "Rock", "Canada", ts("2026-03-01T10:00:00")),
        (2, "Adam Sampson", "Electronic", "United Kingdom", ts("2026-03-01T10:05:00")),
        (3, "Joshua Christian", "Jazz", "United States", ts("2026-03-01T10:10:00")),
    ],
    "DimTrack": [
        (1, "Focused next generation encryption", 1, "Piece Album", 248, d("2022-04-14"), ts("2026-03-01T10:00:00")),
        (2, "Public key object oriented archive", 2, "Late Album", 257, d("2021-03-08"), ts("2026-03-01T10:05:00")),
        (3, "Mandatory intermediate artificial intelligence", 3, "Too Album", 218, d("2023-08-24"), ts("2026-03-01T10:10:00")),
        (4, "Grass roots tangible attitude", 1, "Art Album", 330, d("2023-01-25"), ts("2026-03-01T10:15:00")),
    ],
    "DimDate": [
        (20260301, d("2026-03-01"), 1, 3, 2026, "Sunday"),
        (20260302, d("2026-03-02"), 2, 3, 2026, "Monday"),
        (20260303, d("2026-03-03"), 3, 3, 2026, "Tuesday"),
        (20260304, d("2026-03-04"), 4, 3, 2026, "Wednesday"),
        (20260305, d("2026-03-05"), 5, 3, 2026, "Thursday"),
    ],
    "FactStream": [
        (1001, 1, 1, 20260301, 240, "mobile", ts("2026-03-01T11:00:00")),
        (1002, 2, 2, 20260301, 180, "desktop", ts("2026-03-01T11:05:00")),
        (1003, 3, 3, 20260302, 220, "speaker", ts("2026-03-02T11:10:00")),
        (1004, 4, 4, 20260303, 320, "mobile", ts("2026-03-03T11:15:00")),
        (1005, 5, 1, 20260304, 200, "car", ts("2026-03-04T11:20:00")),
    ],
}
FIRST, SECOND = ts("2026-03-31T06:57:00"), ts("2026-04-01T06:57:00")
ARTIST_OF = {1: 1, 2: 2, 3: 3, 4: 1}
TRACK_STAMP = {1: "10:00", 2: "10:05", 3: "10:10", 4: "10:15"}


def sha(*parts):
    return hashlib.sha256("||".join(map(str, parts)).encode()).hexdigest()


def fact_row(stream, user_run=FIRST):
    key, user, track, day, listened, device, at = stream
    return (
        key, user, track, ARTIST_OF[track], day, listened, device, at, at.date(),
        sha(user, user_run), sha(ARTIST_OF[track], FIRST),
        sha(track, f"2026-03-01 {TRACK_STAMP[track]}:00"), sha(day),
    )


def write_source(spark, root, tables):
    for name, data in tables.items():
        frame = inline_rows(spark, data, SOURCE_DDL[name])
        frame.coalesce(1).write.mode("append").parquet(f"{root}/{name}")


def run(spark, layers, root, at):
    return run_all(
        spark, layers, TABLES, ParquetSource(root), DIMENSIONS, VIEWS, FOREIGN_KEYS, at, run_id="r1"
    )


def test_two_runs(spark, layers, tmp_path, rows):
    root = f"{tmp_path}/source"
    write_source(spark, root, SEEDS)
    published = run(spark, layers, root, FIRST)
    assert {name: done.rows for name, done in published.items()} == {
        "gold_dim_user": 5, "gold_dim_artist": 3, "gold_dim_track": 4, "gold_dim_date": 5, "gold_fact_stream": 5,
    }
    fact = spark.table(layers.gold_table("gold_fact_stream"))
    # The column of the partitions comes last.
    assert sorted(fact.columns) == sorted(FACT_COLUMNS) and fact.columns[-1] == "event_date"
    assert rows(fact, *FACT_COLUMNS) == sorted([fact_row(s) for s in SEEDS["FactStream"]], key=repr)
    flags = spark.table(layers.gold_table("gold_dim_track"))
    assert rows(flags, "track_id", "durationFlag") == [(1, "medium"), (2, "medium"), (3, "medium"), (4, "high")]
    days = spark.table(layers.gold_table("gold_dim_date"))
    assert rows(days, "date_key", "quarter", "fiscal_year", "week_number", "is_weekend", "day_of_year")[0] == (
        20260301, 1, 2026, 9, True, 60,
    )
    users = spark.table(layers.silver_table("DimUser"))
    assert rows(users, "user_name")[0] == ("AMANDA JENKINS",)
    quality = spark.table(layers.metadata_table("data_quality_log"))
    assert rows(quality.groupBy("status").count()) == [("PASS", 12)]
    marks = spark.table(layers.metadata_table(WATERMARKS))
    assert rows(marks, "table_name", "last_load_timestamp", "last_row_count", "load_status", "table_row_count") == [
        ("DimArtist", ts("2026-03-01T10:10:00"), 3, "SUCCESS", 3),
        ("DimDate", ts("2026-03-05T00:00:00"), 5, "SUCCESS", 5),
        ("DimTrack", ts("2026-03-01T10:15:00"), 4, "SUCCESS", 4),
        ("DimUser", ts("2026-03-01T10:20:00"), 5, "SUCCESS", 5),
        ("FactStream", ts("2026-03-04T11:20:00"), 5, "SUCCESS", 5),
    ]
    log = spark.table(layers.metadata_table("pipeline_logs"))
    assert rows(log, "notebook_name", "table_name", "rows_read", "rows_written", "status", "run_id")[0] == (
        "gold_scd2_merge", "dim_user_scd2,dim_artist_scd2", 8, 8, "SUCCESS", "r1",
    )

    # A user changes plan, another only the case of the name, and a stream arrives.
    changed = (1, "Carlos Berry", "Switzerland", "Family", d("2023-10-17"), None, ts("2026-03-02T09:00:00"))
    recased = (2, "amanda jenkins", "Montserrat", "Family", d("2024-09-28"), None, ts("2026-03-02T09:00:00"))
    arrived = (1006, 1, 2, 20260305, 90, "mobile", ts("2026-03-05T08:00:00"))
    write_source(spark, root, {"DimUser": [changed, recased], "FactStream": [arrived]})
    run(spark, layers, root, SECOND)
    history = spark.table(layers.gold_table("gold_dim_user"))
    assert rows(history.filter("user_id in (1, 2)"), "user_id", "subscription_type", "is_current", "end_date") == [
        (1, "Family", True, None), (1, "Premium", False, d("2026-04-01")), (2, "Family", True, None),
    ]
    fact = spark.table(layers.gold_table("gold_fact_stream"))
    streams = [*SEEDS["FactStream"], arrived]
    assert rows(fact, *FACT_COLUMNS) == sorted(
        [fact_row(s, SECOND if s[1] == 1 else FIRST) for s in streams], key=repr
    )
    detail = join_chain(lambda name: spark.table(layers.silver_table(name)), STREAM_DETAIL_JOIN)
    assert rows(detail)[-1] == (1006, 90, 1, "CARLOS BERRY", 2, "Public key object oriented archive")
    assert "dimuser" in [r["tableName"].lower() for r in list_tables(spark, layers.silver).collect()]
    assert len(run_quality(spark, layers, TABLES, [*FOREIGN_KEYS, *MORE_FOREIGN_KEYS])) == 14


def test_broken_expectation_stops_the_refresh(spark, layers, tmp_path, rows):
    root = f"{tmp_path}/source"
    silent = (1006, 1, 2, 20260305, 0, "mobile", ts("2026-03-05T08:00:00"))
    write_source(spark, root, {**SEEDS, "FactStream": [*SEEDS["FactStream"], silent]})
    with pytest.raises(ExpectationError) as caught:
        run(spark, layers, root, FIRST)
    assert caught.value.violations == {"listen_duration_positive": 1}
    assert not table_exists(spark, layers.gold_table("gold_fact_stream"))
    assert table_exists(spark, layers.gold_table("gold_dim_date"))


def test_small_helpers(spark):
    df = inline_rows(spark, [(n,) for n in range(30)], "n int")
    assert preview(df).count() == 20
    temp_view(df, "numbers")
    assert spark.sql("select max(n) from numbers").first()[0] == 29
