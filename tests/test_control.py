from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

import pytest

from siltstone.plans.control import (
    CONFIGS,
    WATERMARK_DDL,
    WATERMARK_UPDATE_DDL,
    WATERMARKS,
    bootstrap,
    config_upsert,
    record_load,
    seed_watermarks,
    watermark_upsert,
    work_list,
)
from siltstone.plans.listening import TABLES
from siltstone.plans.runs import extract_all, extract_to_bronze
from siltstone.sources.incremental import (
    JdbcSource,
    ParquetSource,
    changed_since,
    depth_bounds,
    landing_path,
    measure,
    range_predicates,
)
from siltstone.specs import ColumnRule, Layers, TableSpec, load_table_specs, table_specs

OLD, NEW, NOW = datetime(2026, 1, 1), datetime(2026, 2, 1), datetime(2026, 3, 1)


@pytest.mark.parametrize(
    "stored, update, expected",
    [
        ((OLD, 5), (NEW, 9, "SUCCESS"), (NEW, 9, "SUCCESS")),
        ((OLD, 5), (None, 0, "SUCCESS"), (OLD, 0, "SUCCESS")),
        ((OLD, 5), (NEW, None, "SUCCESS"), (NEW, 5, "SUCCESS")),
        ((OLD, 5), (NEW, 9, "FAILED"), (OLD, 5, "FAILED")),
        (None, (NEW, 9, "SUCCESS"), (NEW, 9, "SUCCESS")),
        (None, (None, None, "SUCCESS"), (None, None, "SUCCESS")),
        (None, (NEW, 9, "FAILED"), (None, None, "FAILED")),
    ],
)
def test_watermark_outcomes(spark, stored, update, expected):
    rows = [("other", OLD, 1, "SUCCESS", OLD, 7)]
    if stored:
        rows.append(("t", *stored, "PENDING", OLD, 3))
    watermarks = spark.createDataFrame(rows, WATERMARK_DDL)
    given = spark.createDataFrame([("t", *update)], WATERMARK_UPDATE_DDL)
    state = {r["table_name"]: tuple(r)[1:] for r in watermark_upsert(watermarks, given, NOW).collect()}
    assert state["t"] == (*expected, NOW, 3 if stored else None)
    assert state["other"] == (OLD, 1, "SUCCESS", OLD, 7)


def test_seed_keeps_known_watermarks(spark, rows):
    watermarks = spark.createDataFrame([("a", OLD, 1, "SUCCESS", OLD, 7)], WATERMARK_DDL)
    names = spark.createDataFrame([("a",), ("b",)], "table_name string")
    assert rows(seed_watermarks(watermarks, names, NOW)) == [
        ("a", OLD, 1, "SUCCESS", OLD, 7),
        ("b", datetime(1900, 1, 1), 0, "PENDING", NOW, None),
    ]


def test_config_upsert_reactivates(spark, rows):
    ddl = "schema_name string, table_name string, cdc_column string, is_active boolean"
    stored = spark.createDataFrame([("s", "a", "x", False), ("s", "c", "x", False)], ddl)
    incoming = spark.createDataFrame([("s", "a", "y", False), ("s", "b", "y", True)], ddl)
    assert rows(config_upsert(stored, incoming)) == [
        ("s", "a", "y", True), ("s", "b", "y", True), ("s", "c", "x", False),
    ]


def test_bootstrap_and_work_list(spark, layers):
    retired = TableSpec("Gone", "updated_at", ("id",), "updated_at", is_active=False)
    for _ in range(2):
        bootstrap(spark, layers, [*TABLES, retired], NOW)
    record_load(spark, layers, "DimUser", "SUCCESS", datetime(2026, 3, 1, 10, 20, 0), 5, NOW)
    tasks = work_list(
        spark.table(layers.metadata_table(CONFIGS)), spark.table(layers.metadata_table(WATERMARKS))
    )
    assert tasks.columns == ["schema_name", "table_name", "cdc_column", "watermark_date"]
    assert [tuple(r)[1:] for r in tasks.collect()] == [
        ("DimArtist", "updated_at", "1900-01-01 00:00:00"),
        ("DimDate", "date", "1900-01-01 00:00:00"),
        ("DimTrack", "updated_at", "1900-01-01 00:00:00"),
        ("DimUser", "updated_at", "2026-03-01 10:20:00"),
        ("FactStream", "stream_timestamp", "1900-01-01 00:00:00"),
    ]
    assert spark.table(layers.metadata_table(WATERMARKS)).count() == 6


SPEC = TableSpec("Items", "changed", ("id",), "changed")


def test_incremental_filter_is_strict_and_pushed_down(spark, tmp_path):
    data = [(1, datetime(2026, 3, 1, 10, 0, 0)), (2, datetime(2026, 3, 1, 10, 0, 1)), (3, None)]
    spark.createDataFrame(data, "id int, changed timestamp").write.parquet(f"{tmp_path}/Items")
    source = spark.read.parquet(f"{tmp_path}/Items")
    past = changed_since(source, SPEC, "2026-03-01 10:00:00")
    assert [r["id"] for r in past.collect()] == [2]
    assert "GreaterThan(changed" in past._jdf.queryExecution().executedPlan().toString()
    assert changed_since(source, SPEC, "2026-03-01 10:00:00", overlap=True).count() == 2
    assert tuple(measure(past, SPEC).first()) == (datetime(2026, 3, 1, 10, 0, 1), 1)


def test_date_watermark(spark):
    spec = TableSpec("D", "date", ("date",), "date")
    df = spark.createDataFrame([(date(2026, 3, 1),), (date(2026, 3, 2),)], "date date")
    assert changed_since(df, spec, "2026-03-01 00:00:00").count() == 1
    assert tuple(measure(df, spec).first()) == (datetime(2026, 3, 2), 2)


def test_relational_source_is_read_in_ranges_of_the_changed_rows(spark):
    """The database is stood in for by a frame; only what is handed to Spark is checked."""
    data = spark.createDataFrame([(1, OLD), (5, NEW), (9, NOW)], "id int, changed timestamp")
    asked, split_by = [], []

    class Reader:
        read = property(lambda self: self)

        def format(self, kind):
            assert kind == "jdbc"
            return self

        def options(self, **options):
            asked.append(options)
            return self

        def load(self):
            return data

        def jdbc(self, url, table, predicates, properties):
            assert (url, table, properties) == ("u", "dbo.Items", {"user": "me"})
            split_by.append(predicates)
            return data

    plain = JdbcSource({"url": "u"})
    assert plain.read(Reader(), replace(SPEC, single_task=True), "2026-01-01 00:00:00").count() == 2
    assert asked == [{"url": "u", "dbtable": "dbo.Items"}]
    split = JdbcSource({"url": "u", "user": "me"}, num_partitions=2, overlap=True)
    assert split.read(Reader(), SPEC, "2026-02-01 00:00:00").count() == 2
    assert asked[-1] == {
        "url": "u", "user": "me", "dbtable": "dbo.Items", "partitionColumn": "id",
        "lowerBound": "5", "upperBound": "9", "numPartitions": "2",
    }
    assert split_by[-1] == ["id <= 5 OR id IS NULL", "id > 5"]
    assert split.read(Reader(), SPEC, "2027-01-01 00:00:00").count() == 0
    assert "partitionColumn" not in asked[-1]
    other = replace(SPEC, split_column=SPEC.cdc_column, num_partitions=3)
    assert split.read(Reader(), other, "2026-02-01 00:00:00").count() == 2
    assert (asked[-1]["partitionColumn"], asked[-1]["numPartitions"]) == (SPEC.cdc_column, "3")
    stamps = [f"{SPEC.cdc_column} > TIMESTAMP '2026-02-01 00:00:00.000000'", "TIMESTAMP '2026-03-01 00:00:00.000000'"]
    assert split_by[-1][1] == f"{stamps[0]} AND {SPEC.cdc_column} <= {stamps[1]}"
    with pytest.raises(ValueError, match="single_task"):
        split.read(Reader(), replace(SPEC, split_column="nowhere"), "2026-02-01 00:00:00")


def test_ranges_are_of_equal_depth(spark):
    """Most values lie in a small part of the span, one of them in a fifth of the rows, and some are missing."""
    values = [*range(4000), *range(10**6, 10**6 + 400), *[7] * 1100, *[None] * 50]
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    predicates = range_predicates("v", depth_bounds(df, "v", 10))
    counts = [df.filter(p).count() for p in predicates]
    assert sum(counts) == len(values)
    hot = max(counts)
    assert 1100 <= hot < 1200 and all(450 < n < 640 for n in counts if n != hot)
    assert depth_bounds(df.filter("false"), "v", 10) == [] and range_predicates("v", []) == ["1 = 1"]
    assert depth_bounds(df, "v", 1) == []
    days = spark.sql("select explode(sequence(date'2026-01-01', date'2026-12-31')) as d, timestamp'2026-01-01 10:00:00.25' as t")
    predicates = range_predicates("d", depth_bounds(days, "d", 4))
    assert predicates[0] == "d <= DATE '2026-04-02' OR d IS NULL"
    assert [days.filter(p).count() for p in predicates] == [92, 91, 91, 91]
    stamp = range_predicates("t", depth_bounds(days, "t", 2))
    assert [days.filter(p).count() for p in stamp] == [365, 0]


def test_landing_path():
    assert landing_path("/b/Items", SPEC, datetime(2026, 3, 1, 1, 2, 3)) == "/b/Items/items_20260301010203.parquet"


def test_extract_moves_the_watermark_only_on_success(spark, layers, tmp_path, rows):
    root = f"{tmp_path}/source"
    ddl = "id int, changed timestamp"
    spark.createDataFrame([(1, OLD), (2, NEW)], ddl).write.parquet(f"{root}/Items")
    bootstrap(spark, layers, [SPEC], OLD)
    marks = layers.metadata_table(WATERMARKS)
    columns = ("last_load_timestamp", "last_row_count", "load_status", "last_updated_at")

    done = extract_all(spark, layers, [SPEC], ParquetSource(root), NOW)["Items"]
    assert (done.rows, done.location.split("/")[-2]) == (2, "items_20260301000000.parquet")
    assert rows(spark.table(marks), *columns) == [(NEW, 2, "SUCCESS", NOW)]

    later = datetime(2026, 3, 2)
    assert extract_all(spark, layers, [SPEC], ParquetSource(root), later)["Items"].rows == 0
    assert rows(spark.table(marks), *columns) == [(NEW, 0, "SUCCESS", later)]

    last = datetime(2026, 3, 3)
    with pytest.raises(Exception):
        extract_to_bronze(spark, layers, SPEC, ParquetSource(f"{root}/none"), "1900-01-01 00:00:00", last)
    assert rows(spark.table(marks), *columns) == [(NEW, 0, "FAILED", last)]


def test_specs_from_configuration(tmp_path):
    entry = {
        "table_name": "Items", "source_schema": "dbo", "cdc_column": "changed",
        "primary_keys": ["id"], "bronze_path": "in/Items", "silver_table": "items",
        "target_path": "out/items", "partition_by": ["day"], "deduplicate_order_column": "changed",
    }
    (tmp_path / "tables.json").write_text(__import__("json").dumps({"tables": [entry]}))
    rule = ColumnRule("name", lambda c: c)
    (spec,) = load_table_specs(str(tmp_path / "tables.json"), {"Items": [rule]})
    assert (spec.primary_keys, spec.partition_by, spec.rules) == (("id",), ("day",), (rule,))
    layers = Layers("/root")
    assert layers.bronze(spec) == "/root/bronze/in/Items"
    assert layers.stream_state(spec, "schema") == "/root/silver_state/out/items/schema"
    with pytest.raises(ValueError, match="twice"):
        table_specs([entry, entry])
    with pytest.raises(ValueError, match="cdc_column"):
        table_specs([{**entry, "cdc_column": "", "deduplicate_order_column": "x"}])
    with pytest.raises(ValueError, match="list"):
        table_specs([{**entry, "primary_keys": "id"}])


def test_layer_names_from_session_configuration(spark):
    layers = Layers.from_conf(spark, "/root", {"silver_schema": "s1", "catalog_name": "spark_catalog"})
    assert layers.silver_table("t") == "spark_catalog.s1.t"
    spark.conf.set("silver_schema", "s2")
    try:
        assert Layers.from_conf(spark, "/root", {"silver_schema": "s1"}).silver_table("t") == "s2.t"
    finally:
        spark.conf.unset("silver_schema")
