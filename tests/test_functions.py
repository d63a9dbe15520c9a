from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import functions as F

from siltstone.functions.derive import (
    RESCUED,
    bucket,
    calendar_columns,
    conform,
    number_text,
    percent,
)
from siltstone.functions.hashing import hash_key
from siltstone.plans.listening import DURATION_ABOVE, DURATION_BOUNDS, RULES


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_hash_skips_nulls_unless_told_otherwise(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain = [r[0] for r in df.select(hash_key("x", "y", "z")).collect()]
    assert plain == [sha("a||b")] * 2
    marked = [r[0] for r in df.select(hash_key("x", "y", "z", null_token="~")).collect()]
    assert marked == [sha("a||~||b"), sha("a||b||~")]


def test_hash_of_typed_columns(spark):
    df = spark.sql("select 7 as k, timestamp'2026-03-31 06:57:00' as ts, cast(null as int) as n")
    assert df.select(hash_key("k", "ts")).first()[0] == sha("7||2026-03-31 06:57:00")
    assert df.select(hash_key("n")).first()[0] == sha("")


def test_duration_bucket_bounds_and_null(spark):
    df = spark.createDataFrame([(149,), (150,), (299,), (300,), (None,)], "d int")
    labels = df.select(bucket(F.col("d"), DURATION_BOUNDS, DURATION_ABOVE)).collect()
    assert [r[0] for r in labels] == ["low", "medium", "medium", "high", "high"]


def test_calendar(spark):
    days = [date(2026, 3, 1), date(2026, 3, 2), date(2021, 1, 1), date(2024, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    got = [tuple(r)[1:] for r in df.withColumns(calendar_columns(F.col("date"))).collect()]
    assert got == [
        (1, 2026, 9, True, 60),
        (1, 2026, 10, False, 61),
        (1, 2021, 53, False, 1),
        (4, 2024, 1, False, 366),
    ]
    july = df.select(calendar_columns(F.col("date"), fiscal_start_month=7)["fiscal_year"])
    assert [r[0] for r in july.collect()] == [2026, 2026, 2021, 2025]


def test_number_text_and_percent(spark):
    cases = [(0, 10), (1, 3), (1, 1000000), (1, 1), (3, 0), (1, 8)]
    df = spark.createDataFrame(cases, "p bigint, w bigint")
    text = df.select(number_text(percent(F.col("p"), F.col("w"), 4), 4)).collect()
    want = [str(0.0 if w == 0 else round(p / w * 100, 4)) for p, w in cases]
    assert [r[0] for r in text] == want == ["0.0", "33.3333", "0.0001", "100.0", "0.0", "12.5"]


def test_conform_rules(spark):
    user = spark.createDataFrame([("Ann Lee", "{}")], f"user_name string, {RESCUED} string")
    assert conform(user, RULES["DimUser"]).collect() == [("ANN LEE",)]
    track = spark.createDataFrame([("a-b--c",)], "track_name string")
    assert conform(track, RULES["DimTrack"]).collect() == [("a b  c",)]
    stream = spark.sql("select timestamp'2026-03-01 23:59:59' as stream_timestamp")
    assert conform(stream, RULES["FactStream"]).first()["event_date"] == date(2026, 3, 1)
    other = spark.sql("select 1 as x")
    assert conform(other, RULES["FactStream"]).columns == ["x"]
