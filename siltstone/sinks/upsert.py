"""Keyed upsert of a batch into a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampType

from siltstone.operators.keyed import (
    INCOMING,
    KEY_BUCKET,
    bucket_column,
    key_match,
    newer_than_stored,
    upsert_newest,
    with_buckets,
    without_keys,
)
from siltstone.sinks.ledger import Ledger
from siltstone.sinks.publish import (
    layout_of,
    new_snapshot_path,
    partition_filter,
    partition_keys,
    point_table,
    publish_table,
    quoted_table,
    swap_partitions,
    write_snapshot,
)
from siltstone.specs import quoted

ROW_LEVEL_PROVIDERS = {"delta", "iceberg", "hudi"}
BOUNDED = (NumericType, DateType, TimestampType, StringType)


@dataclass(frozen=True)
class Merged:
    """What an upsert did; ``rows_copied`` are stored rows written again beside the changed ones."""

    rows_inserted: int
    rows_updated: int
    rows_copied: int = field(default=0, compare=False)

    @property
    def rows_written(self) -> int:
        return self.rows_inserted + self.rows_updated


def provider(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_table(table)}")
    row = described.filter("col_name = 'Provider'").first()
    return (row["data_type"] if row else "").lower()


def read_state(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a keyed table without the column it is laid out by."""
    df = spark.table(table)
    bucket = bucket_column(df.columns)
    return df.drop(bucket) if bucket else df


def rebucket_table(
    spark: SparkSession, table: str, keys: Sequence[str], buckets: int, partition_by: Sequence[str] = ()
) -> None:
    """Lay a table out by another number of buckets, 0 for none. It is written whole, once."""
    laid, layout = _laid_out(read_state(spark, table), keys, buckets, partition_by)
    publish_table(laid, table, layout)


def _laid_out(
    df: DataFrame, keys: Sequence[str], buckets: int, partition_by: Sequence[str]
) -> tuple[DataFrame, tuple[str, ...]]:
    if not buckets:
        return df, tuple(partition_by)
    return with_buckets(df, keys, buckets), (*partition_by, f"{KEY_BUCKET}{buckets}")


def reads_once(spark: SparkSession, table: str, guarded: bool) -> bool:
    """Whether :func:`upsert_table` reads its batch once: to create the table, or to merge a whole one under a guard."""
    if not spark.catalog.tableExists(table):
        return True
    return guarded and not layout_of(spark, table) and provider(spark, table) not in ROW_LEVEL_PROVIDERS


def upsert_table(
    batch: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    guard_order: str | Sequence[str] | None = None,
    stable_partitions: bool = False,
    buckets: int = 0,
    ledger: Ledger | None = None,
) -> Merged:
    """Update matched rows, insert the others, create the table on first use.

    ``batch`` must be unique per key and is read several times, so persist it unless
    :func:`reads_once`. A table created
    with ``buckets`` is laid out by a hash of its keys, and later upserts find that out by
    themselves: only buckets of the batch are read and rewritten. Of a partitioned table only
    affected partitions are: those of incoming rows and those holding a row that is being
    replaced. Finding the latter scans the key columns once, within the batch's buckets and
    the bounds of its first key, unless ``stable_partitions`` promises that a key stays put. A
    table with neither is rewritten whole. A provider with row-level operations gets a MERGE
    instead. Columns that the table lacks raise an error. With ``guard_order`` (columns as
    for :func:`newer_than_stored`) newer stored rows stay. A ``ledger`` notes the operation.
    """
    spark = batch.sparkSession
    if buckets and not keys:
        raise ValueError("buckets need at least one key column")
    if not spark.catalog.tableExists(table):
        laid, layout = _laid_out(batch, keys, buckets, partition_by)
        return Merged(publish_table(laid, table, layout, ledger=ledger).rows, 0)
    if not keys:
        raise ValueError("an upsert needs at least one key column")

    target = spark.table(table)
    known = {c.lower() for c in target.columns}
    if unknown := [c for c in batch.columns if c.lower() not in known]:
        raise ValueError(f"{table} lacks columns of the batch: {', '.join(unknown)}")
    bucket = bucket_column(target.columns)
    count = int(bucket.removeprefix(KEY_BUCKET)) if bucket else 0
    batch = batch.select(*[quoted(c) for c in target.columns if c != bucket])
    batch, layout = _laid_out(batch, keys, count, partition_by)
    batch = batch.select(*[quoted(c) for c in target.columns])

    moving = layout and not stable_partitions and layout != (bucket,)
    if not guard_order and not moving:
        return _merge(batch, None, target, table, keys, layout, ledger)
    order = [guard_order] if isinstance(guard_order, str) else list(guard_order or ())
    if not layout and provider(spark, table) not in ROW_LEVEL_PROVIDERS:
        return _merge_newest(batch, target, table, keys, order, ledger)
    matched = matched_rows(target, batch, keys, [*order, *layout]).persist()
    try:
        if not guard_order:
            if batch.isEmpty():
                return Merged(0, 0)
            return _merge(batch, matched, target, table, keys, layout, ledger)
        accepted = newer_than_stored(matched, batch, keys, order).persist()
        try:
            if accepted.isEmpty():
                return Merged(0, 0)
            return _merge(accepted, _matching(matched, accepted, keys), target, table, keys, layout, ledger)
        finally:
            accepted.unpersist()
    finally:
        matched.unpersist()


def matched_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys and ``columns`` of the stored rows that the batch meets: one narrow scan, no more rows than the batch has.

    The scan is pruned to the batch's buckets, and to row groups within the bounds of its first key.
    """
    bucket = bucket_column(target.columns)
    if bucket:
        target = target.filter(partition_filter(target.schema, [bucket], partition_keys(batch, [bucket])))
    within = _key_bounds(target, batch, keys[0])
    if within is not None:
        target = target.filter(within)
    narrow = target.select(*[quoted(c) for c in dict.fromkeys([*keys, *columns])])
    return _matching(narrow, batch, keys)


def _key_bounds(target: DataFrame, batch: DataFrame, key: str) -> Column | None:
    kind = target.schema[key].dataType
    if not isinstance(kind, BOUNDED) or batch.schema[key].dataType != kind:
        return None
    column = F.col(quoted(key))
    low, high = batch.agg(F.min(column), F.max(column)).first()
    return F.lit(False) if low is None else column.between(F.lit(low).cast(kind), F.lit(high).cast(kind))


def _matching(rows: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    wanted = batch.select(*[quoted(k) for k in keys])
    return rows.alias("t").join(wanted.alias("b"), key_match(keys, "t", "b"), "left_semi")


def _merge(
    batch: DataFrame,
    matched: DataFrame | None,
    target: DataFrame,
    table: str,
    keys: Sequence[str],
    layout: Sequence[str],
    ledger: Ledger | None,
) -> Merged:
    """Merge accepted rows; ``matched`` are the stored rows they replace, if those were looked up."""
    spark = batch.sparkSession
    if provider(spark, table) in ROW_LEVEL_PROVIDERS:
        return _merge_into(batch, target, table, keys, ledger)
    affected = set()
    if layout:
        affected = partition_keys(batch, layout)
        if matched is not None:
            affected |= partition_keys(matched, layout)
        if not affected:
            return Merged(0, 0)
        target = target.filter(partition_filter(target.schema, layout, affected))
    operation = ledger.start(table, "UPSERT", layout, affected if layout else None) if ledger else None

    # Without the matched rows, how many there were follows from the count of the files that
    # are replaced, which comes from their footers; the rest is counted by the write. Both
    # are taken before the table moves, which would refresh what is cached of it.
    before = target.count() if matched is None else None
    updated = 0 if matched is None else matched.count()
    # No stored row goes if none matched: the rows are then added without a join.
    left = target if matched is not None and not updated else without_keys(target, batch, keys)
    state = (
        left
        .withColumn(INCOMING, F.lit(False))
        .unionByName(batch.withColumn(INCOMING, F.lit(True)))
    )
    metrics = {"rows_incoming": F.count_if(F.col(INCOMING))}
    if layout:
        done = write_snapshot(state, new_snapshot_path(spark, table), layout, metrics, drop=(INCOMING,))
        swap_partitions(spark, table, layout, done.location, affected)
        spark.catalog.refreshTable(table)
    else:
        done = publish_table(state, table, metrics=metrics, drop=(INCOMING,))
    incoming = int(done.metrics.get("rows_incoming") or 0)
    copied = done.rows - incoming
    if matched is None:
        updated = before - copied
    merged = Merged(incoming - updated, updated, copied)
    if operation:
        ledger.finish(operation, done.location, incoming, merged.rows_inserted, merged.rows_updated, done.rows)
    return merged


def _merge_newest(
    batch: DataFrame, target: DataFrame, table: str, keys: Sequence[str], order: Sequence[str], ledger: Ledger | None
) -> Merged:
    """Merge what the guard lets pass into a table that is rewritten whole, in one pass over both.

    How many rows passed is known once the new files are written; if none did, the table stays with its old ones.
    """
    spark = batch.sparkSession
    # From the files' footers, before the table moves.
    before = target.count()
    state = upsert_newest(target, batch, keys, order)
    metrics = {"rows_incoming": F.count_if(F.col(INCOMING))}
    done = write_snapshot(state, new_snapshot_path(spark, table), (), metrics, drop=(INCOMING,))
    incoming = int(done.metrics.get("rows_incoming") or 0)
    if not incoming:
        return Merged(0, 0)
    operation = ledger.start(table, "UPSERT") if ledger else None
    point_table(state.drop(INCOMING), table, done)
    copied = done.rows - incoming
    updated = before - copied
    merged = Merged(incoming - updated, updated, copied)
    if operation:
        ledger.finish(operation, done.location, incoming, merged.rows_inserted, merged.rows_updated, done.rows)
    return merged


def _merge_into(
    batch: DataFrame, target: DataFrame, table: str, keys: Sequence[str], ledger: Ledger | None
) -> Merged:
    """Row-level MERGE. Counts come from a join on the keys made before the merge."""
    total, updated = batch.count(), _matching(target, batch, keys).count()
    operation = ledger.start(table, "UPSERT") if ledger else None
    condition = " AND ".join(
        f"{quoted(table.split('.')[-1])}.{quoted(k)} = b.{quoted(k)}" for k in keys
    )
    (
        batch.alias("b")
        .mergeInto(table, F.expr(condition))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
    if operation:
        ledger.finish(operation, "", total, total - updated, updated, total)
    return Merged(total - updated, updated)
