"""Plans at scale: what is pushed down, what is shuffled, what happens to a hot key."""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import functions as F

from registered.relations import Tables
from siltstone.operators.joins import Lookup, resolve_keys
from siltstone.operators.keyed import without_keys
from siltstone.plans.listening import VIEWS
from siltstone.session import shared_dir, stored
from siltstone.sinks.publish import publish_table

SMALL = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    values = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


SKEWED = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
}


def hot_fact(spark, hot):
    rows = spark.range(0, 60000, numPartitions=8)
    return rows.select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id")).cast("bigint").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


def test_hot_keys_and_nulls_are_split_in_lookups(spark):
    dim = spark.range(0, 60000, numPartitions=4).select(
        F.col("id").alias("k"), F.col("id").cast("string").alias("name")
    )
    for hot in (1, None):
        with settings(spark, **SKEWED):
            got = resolve_keys(hot_fact(spark, hot), [Lookup(dim, ("k",), ("name",))])
            assert got.filter("name is not null").count() == (60000 if hot else 40000)
            frame = got.select(F.sum(F.length("payload")))
            frame.collect()
            assert "skew=true" in plan_of(frame)


def test_hot_null_keys_are_split_in_upserts(spark):
    batch = spark.range(0, 60000, numPartitions=4).select(F.col("id").alias("k"))
    with settings(spark, **SKEWED):
        kept = without_keys(hot_fact(spark, None), batch, ["k"]).agg(F.sum(F.length("payload")))
        assert kept.collect()[0][0] == 20000 * 64
        assert "skew=true" in plan_of(kept)


def test_fact_joins_the_artist_on_the_track_side(spark):
    t = Tables(spark, SMALL)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(VIEWS.build("gold_fact_stream", t.silver, lambda name: stored(t.gold(name), "dimension")))
    on_fact = re.findall(r"SortMergeJoin \[(\w+)#\d+L?\], \[\w+#\d+L?\], LeftOuter", plan)
    assert on_fact.count("artist_id") == 1 and on_fact.index("artist_id") > on_fact.index("track_id")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hot_partition_is_written_as_several_files(spark, layers):
    rows = hot_fact(spark, None).withColumn("day", F.when(F.col("k").isNotNull(), F.col("k") % 5))
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="300KB"):
        publish_table(rows, layers.silver_table("t"), ["day"])
    files = spark.table(layers.silver_table("t")).inputFiles()
    hot = [f for f in files if "HIVE_DEFAULT" in f]
    assert 2 <= len(hot) <= 20 and len(files) - len(hot) <= 25


def test_stored_rows_prune_columns(spark):
    kept = stored(spark.sql("select 1 as a, 2 as b"), "t")
    assert "ReadSchema: struct<a:int>" in plan_of(kept.select("a"))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
