"""Profiles of tables kept by partition, so that a check reads only what was written since the last one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.quality import (
    KEY_PROFILES,
    merged_profiles,
    partition_key,
    partition_profiles,
    profile,
)
from siltstone.plans.control import OPERATIONS, PROFILES
from siltstone.session import stored
from siltstone.sinks.ledger import Ledger
from siltstone.sinks.publish import layout_of, partition_filter
from siltstone.sinks.upsert import upsert_table
from siltstone.specs import Layers


def current_profiles(
    spark: SparkSession, layers: Layers, tables: Mapping[str, str], keys: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Profiles of the tables (name to catalog name), from kept ones brought up to date.

    Partitions that the operation ledger names since the last profile are read again, or all of a table
    that was replaced, whose keys were declared otherwise, or that has no kept profile. A table
    whose writers keep no ledger is scanned each time.
    """
    ledger = Ledger(spark, layers.metadata_table(OPERATIONS))
    versions = {name: ledger.version(table) for name, table in tables.items()}
    noted = [name for name, version in versions.items() if version]
    changes = [
        change
        for name in noted
        if (change := changed_profiles(spark, layers, name, tables[name], keys[name], versions[name])) is not None
    ]
    kept = layers.metadata_table(PROFILES)
    if changes:
        batch = stored(reduce(DataFrame.unionByName, changes), "profiles")
        upsert_table(batch, kept, ["table_name", "partition_key"], ["table_name"], stable_partitions=True)
    frames = [
        profile(spark.table(table), name, keys[name]).select("table_name", "total_rows", "key_nulls")
        for name, table in tables.items()
        if name not in noted
    ]
    if noted:
        merged = merged_profiles(spark.table(kept).filter(F.col("table_name").isin(noted)))
        plain = F.transform("key_nulls", lambda e: F.struct(e["column"].alias("column"), e["null_rows"].alias("null_rows")))
        frames.append(merged.select("table_name", "total_rows", plain.alias("key_nulls")))
    return reduce(DataFrame.unionByName, frames)


def changed_profiles(
    spark: SparkSession, layers: Layers, name: str, table: str, keys: Sequence[str], version: int
) -> DataFrame | None:
    """New profiles of the partitions that changed up to ``version``, with zeros for those that went; None if none did."""
    state = spark.table(layers.metadata_table(PROFILES)).filter(F.col("table_name") == name)
    declared = ",".join(keys)
    known = state.agg(F.max("version").alias("seen"), F.collect_set("key_columns").alias("declared")).first()
    layout = layout_of(spark, table)
    touched = None
    if known["seen"] is not None and known["declared"] == [declared]:
        touched = Ledger(spark, layers.metadata_table(OPERATIONS)).touched(table, known["seen"], layout)
        if touched is not None and not touched:
            return None
    rows = spark.table(table)
    before = state.select("partition_key")
    if touched is not None:
        rows = rows.filter(partition_filter(rows.schema, layout, touched))
        before = before.filter(F.col("partition_key").isin([partition_key(layout, key) for key in touched]))
    found = stored(partition_profiles(rows, keys, layout), "profile")
    gone = before.join(found, "partition_key", "left_anti").select(
        "partition_key", F.lit(0).cast("bigint").alias("total_rows"), F.array().cast(KEY_PROFILES).alias("key_profiles")
    )
    return found.unionByName(gone).select(
        "partition_key", F.lit(version).cast("bigint").alias("version"), F.lit(declared).alias("key_columns"),
        "total_rows", "key_profiles", F.lit(name).alias("table_name"),
    )
