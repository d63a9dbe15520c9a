"""Data-quality checks that yield log rows: NULL keys, row-count drift, orphans."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.derive import number_text, percent
from siltstone.specs import ForeignKey, quoted

PASS, FAIL, WARNING = "PASS", "FAIL", "WARNING"
DRIFT_LIMIT_PCT = 50
KEY_PROFILES = "array<struct<column:string,null_rows:bigint,distinct_keys:binary>>"
CHECK_COLUMNS = ("table_name", "check_name", "status", "details")


def profile(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """One row: the row count and the NULL count of every key, in one pass."""
    return df.agg(
        F.lit(table).alias("table_name"),
        F.count(F.lit(1)).alias("total_rows"),
        F.array(
            *[
                F.struct(
                    F.lit(key).alias("column"),
                    F.count_if(F.col(quoted(key)).isNull()).alias("null_rows"),
                )
                for key in keys
            ]
        ).cast("array<struct<column:string,null_rows:bigint>>").alias("key_nulls"),
    )


def profiles(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """The profiles of several tables; one job whose branches run side by side."""
    return reduce(
        DataFrame.unionByName, [profile(df, name, keys[name]) for name, df in tables.items()]
    )


def partition_key(partition_by: Sequence[str], values: Sequence[str | None]) -> str:
    """The values of a partition as one JSON text, as :func:`partition_profiles` names it."""
    return json.dumps(dict(zip(partition_by, values)), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def partition_profiles(df: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """Profiles that add up: rows, NULLs and a sketch of the distinct values of every key, by partition.

    One row per partition with rows, and one of an empty table, so that a table without rows has a
    profile as well. A table without partitions is one of its own.
    """
    entries = [
        F.struct(
            F.lit(key).alias("column"),
            F.count_if(F.col(quoted(key)).isNull()).alias("null_rows"),
            F.hll_sketch_agg(F.col(quoted(key)).cast("string")).alias("distinct_keys"),
        )
        for key in keys
    ]
    measures = [F.count(F.lit(1)).alias("total_rows"), F.array(*entries).cast(KEY_PROFILES).alias("key_profiles")]
    columns = ("partition_key", "total_rows", "key_profiles")
    if not partition_by:
        return df.agg(*measures).withColumn("partition_key", F.lit("{}")).select(*columns)
    values = [F.nullif(F.col(quoted(c)).cast("string"), F.lit("")).alias(c) for c in sorted(partition_by)]
    named = F.to_json(F.struct(*values), {"ignoreNullFields": "false"}).alias("partition_key")
    empty = df.limit(0).agg(*measures).withColumn("partition_key", F.lit("")).select(*columns)
    return df.groupBy(named).agg(*measures).select(*columns).unionByName(empty)


def merged_profiles(parts: DataFrame) -> DataFrame:
    """Profiles of whole tables, as from :func:`profiles`, from those of their partitions.

    Each key has an estimate of its distinct values besides: the sketches merge without a second look at
    the rows.
    """
    totals = parts.groupBy("table_name").agg(F.sum("total_rows").alias("total_rows"))
    each = parts.select("table_name", F.posexplode("key_profiles").alias("place", "entry")).select("table_name", "place", "entry.*")
    per_key = each.groupBy("table_name", "place", "column").agg(
        F.sum("null_rows").alias("null_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_keys")).alias("distinct_keys"),
    )
    fields = ("place", "column", "null_rows", "distinct_keys")
    in_order = F.sort_array(F.collect_list(F.struct(*fields)))
    bare = F.transform(in_order, lambda e: F.struct(*[e[f].alias(f) for f in fields[1:]]))
    listed = per_key.groupBy("table_name").agg(bare.alias("key_nulls"))
    joined = totals.join(listed, "table_name", "left")
    none = F.array().cast("array<struct<column:string,null_rows:bigint,distinct_keys:bigint>>")
    return joined.withColumn("key_nulls", F.coalesce("key_nulls", none))


def _check(table: Column, name: Column, status: Column, details: Column) -> Column:
    values = (table, name, status, details)
    return F.struct(*[v.alias(c) for c, v in zip(CHECK_COLUMNS, values)])


def _null_check(entry: Column) -> Column:
    nulls, total = entry["null_rows"], F.col("total_rows")
    return _check(
        F.col("table_name"),
        F.concat(F.lit("pk_null_rate_"), entry["column"]),
        F.when(nulls == 0, F.lit(PASS)).otherwise(F.lit(FAIL)),
        F.concat(
            F.lit("column="), entry["column"],
            F.lit(", null_rows="), nulls.cast("string"),
            F.lit(", total_rows="), total.cast("string"),
            F.lit(", null_rate="), number_text(percent(nulls, total, 4), 4), F.lit("%"),
        ),
    )


def _drift_check() -> Column:
    current, previous = F.col("total_rows"), F.col("previous_count")
    comparable = previous.isNotNull() & (previous != 0)
    drift = F.abs(current - previous) / F.when(comparable, previous) * F.lit(100.0)
    counts = F.concat(
        F.lit("current_count="), current.cast("string"),
        F.lit(", previous_count="), F.coalesce(previous.cast("string"), F.lit("None")),
    )
    return _check(
        F.col("table_name"),
        F.lit("row_count_delta_check"),
        F.when(comparable & (drift > DRIFT_LIMIT_PCT), F.lit(WARNING)).otherwise(F.lit(PASS)),
        F.when(
            comparable,
            F.concat(counts, F.lit(", delta_pct="), number_text(F.bround(drift, 2), 2)),
        ).otherwise(counts),
    )


def _unpacked(df: DataFrame, checks: Column) -> DataFrame:
    return df.select(F.explode(checks).alias("check")).select(
        *[F.col(f"check.{c}") for c in CHECK_COLUMNS]
    )


def pk_null_checks(measured: DataFrame) -> DataFrame:
    """A check row per table and key column from :func:`profiles`."""
    return _unpacked(measured, F.transform("key_nulls", _null_check))


def with_previous_counts(measured: DataFrame, watermarks: DataFrame, column: str) -> DataFrame:
    """Attach the previously recorded row count of each table."""
    previous = watermarks.select("table_name", F.col(quoted(column)).alias("previous_count"))
    return measured.join(previous, "table_name", "left")


def row_drift_checks(measured: DataFrame) -> DataFrame:
    """A check row per table comparing with ``previous_count``; a missing or zero one passes."""
    return _unpacked(measured, F.array(_drift_check()))


def table_checks(measured: DataFrame) -> DataFrame:
    """NULL and drift checks together, from a single pass over the profiles."""
    return _unpacked(
        measured,
        F.concat(F.transform("key_nulls", _null_check), F.array(_drift_check())),
    )


def orphans(child: DataFrame, parent: DataFrame, key: ForeignKey) -> DataFrame:
    """Distinct child keys without a parent; NULL counts as one of them.

    The child is reduced to distinct keys before the join, so a hot key leaves each
    task only once; the parent needs no distinct for an anti join.
    """
    return (
        child.select(F.col(quoted(key.column)).alias("orphan_key"))
        .distinct()
        .join(
            parent.select(F.col(quoted(key.target_column)).alias("parent_key")),
            F.col("orphan_key") == F.col("parent_key"),
            "left_anti",
        )
    )


def foreign_key_checks(read: Callable[[str], DataFrame], keys: Sequence[ForeignKey]) -> DataFrame:
    """A check row per foreign key."""
    frames = []
    for key in keys:
        count = F.col("orphan_count")
        frames.append(
            orphans(read(key.child), read(key.parent), key)
            .agg(F.count(F.lit(1)).alias("orphan_count"))
            .select(
                F.lit(key.child).alias("table_name"),
                F.lit(f"referential_integrity_{key.column}").alias("check_name"),
                F.when(count == 0, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
                F.concat(F.lit(f"orphan_{key.column}s="), count.cast("string")).alias("details"),
            )
        )
    return reduce(DataFrame.unionByName, frames)


def run_checks(
    read: Callable[[str], DataFrame],
    keys: Mapping[str, Sequence[str]],
    foreign_keys: Sequence[ForeignKey],
    watermarks: DataFrame,
    count_column: str,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Every check of a run as one frame: NULL keys, drift, then foreign keys.

    ``measured`` are profiles that are known already; without them each table is scanned.
    """
    if measured is None:
        measured = profiles({name: read(name) for name in keys}, keys)
    measured = with_previous_counts(measured, watermarks, count_column)
    checks = table_checks(measured)
    if foreign_keys:
        checks = checks.unionByName(foreign_key_checks(read, foreign_keys))
    return checks
