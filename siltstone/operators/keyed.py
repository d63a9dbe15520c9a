"""Operators over key-unique state: latest row per key, upserts, conditional updates.

All are pure plans. The state is always the left side of the join, so AQE may split a
hot partition of it (rows with NULL keys, say) and broadcast the batch once its real
size is known.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from siltstone.specs import quoted

MATCHED = "_matched"
# Marks incoming rows among stored ones.
INCOMING = "_incoming"
# The column a bucketed table is laid out by; its name ends with the number of buckets.
KEY_BUCKET = "_key_bucket_of_"


def sortable(kind: DataType) -> bool:
    if isinstance(kind, (MapType, VariantType)):
        return False
    if isinstance(kind, ArrayType):
        return sortable(kind.elementType)
    if isinstance(kind, StructType):
        return all(sortable(field.dataType) for field in kind.fields)
    return True


def total_order(
    schema: StructType, keys: Sequence[str], order_column: str, tie_breakers: Sequence[str] = ()
) -> list[str]:
    """Columns that order the rows of a key: greatest first, equal only if the rows are."""
    others = [field.name for field in schema.fields if sortable(field.dataType)]
    return [c for c in dict.fromkeys([order_column, *tie_breakers, *others]) if c not in keys]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_column: str,
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """The row with the greatest ``order_column`` per key; NULL order sorts last.

    Ties are broken by ``tie_breakers``, then by all remaining columns. That makes the
    choice a function of the data alone, so a recomputed partition chooses the same row.
    Without keys the input is returned. The rank filter lets Spark cut every group to
    one row per task before the shuffle: a hot key sends one row per task, not all.
    """
    if not keys:
        return df
    ordering = total_order(df.schema, keys, order_column, tie_breakers)
    order = [F.col(quoted(c)).desc_nulls_last() for c in ordering]
    window = Window.partitionBy(*[F.col(quoted(k)) for k in keys]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def key_match(keys: Sequence[str], left: str, right: str) -> Column:
    """Plain equality on all keys, so a NULL key matches nothing."""
    if not keys:
        raise ValueError("an upsert needs at least one key column")
    return reduce(
        Column.__and__,
        [F.col(f"{left}.{quoted(k)}") == F.col(f"{right}.{quoted(k)}") for k in keys],
    )


def with_buckets(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Add the bucket of each row, a hash of the text of its keys; NULL keys share one."""
    hashed = F.xxhash64(*[F.col(quoted(k)).cast("string") for k in keys])
    return df.withColumn(f"{KEY_BUCKET}{buckets}", F.pmod(hashed, F.lit(buckets)).cast("int"))


def bucket_column(columns: Sequence[str]) -> str | None:
    """The bucket column among the given ones."""
    return next((c for c in columns if c.lower().startswith(KEY_BUCKET)), None)


def without_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in ``batch``."""
    wanted = batch.select(*[quoted(k) for k in keys])
    return target.alias("t").join(wanted.alias("b"), key_match(keys, "t", "b"), "left_anti")


def newer_than_stored(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: str | Sequence[str]
) -> DataFrame:
    """Rows of ``batch`` not older than the stored row of the same key.

    ``order`` columns are compared one after the other, NULL as the smallest; with those
    of :func:`total_order` the outcome does not depend on how rows were cut into batches.
    The stored rows are narrowed to key and order columns and semi-joined to the batch,
    so only keys that lose travel on.
    """
    order = [order] if isinstance(order, str) else list(order)
    columns = [quoted(c) for c in dict.fromkeys([*keys, *order])]
    stored, incoming = (F.struct(*[F.col(f"{side}.{quoted(c)}") for c in order]) for side in "tb")
    older = stored > incoming
    losing = target.select(*columns).alias("t").join(
        batch.select(*columns).alias("b"), key_match(keys, "t", "b") & older, "left_semi"
    )
    return without_keys(batch, losing, keys)


def upsert_newest(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: str | Sequence[str]
) -> DataFrame:
    """:func:`upsert` of the rows that :func:`newer_than_stored` lets pass, in one shuffle that reads both sides once.

    A key's incoming rows replace the stored ones unless its greatest stored row is greater than
    its least incoming one. Rows with a NULL key match nothing: all stay, and they are spread
    by the hash of their order. Adds a column that marks the incoming rows.
    """
    order = [order] if isinstance(order, str) else list(order)
    rows = target.withColumn(INCOMING, F.lit(False)).unionByName(
        batch.select(*[quoted(c) for c in target.columns]).withColumn(INCOMING, F.lit(True))
    )
    alone = reduce(Column.__or__, [F.col(quoted(k)).isNull() for k in keys])
    spread = F.when(alone, F.xxhash64(*[F.col(quoted(c)) for c in order]))
    window = Window.partitionBy(*[F.col(quoted(k)) for k in keys], spread)
    place, incoming = F.struct(*[F.col(quoted(c)) for c in order]), F.col(INCOMING)
    newest = F.max(F.when(~incoming, place)).over(window)
    oldest = F.min(F.when(incoming, place)).over(window)
    loses = F.coalesce(newest > oldest, F.lit(False))
    kept = alone | F.when(incoming, ~loses).otherwise(loses | oldest.isNull())
    return rows.withColumn(MATCHED, kept).filter(MATCHED).drop(MATCHED)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State after replacing matched rows and inserting the others.

    ``batch`` must be unique per key. The incoming row wins even when it is older; to
    keep newer stored rows, narrow the batch with :func:`newer_than_stored` first. A
    NULL key never matches and is inserted again each time. The batch is used twice, so
    give one that is stored or persisted.
    """
    rows = batch.select(*[quoted(c) for c in target.columns])
    return without_keys(target, rows, keys).unionByName(rows)


def insert_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State after inserting only the rows whose key is not stored yet."""
    rows = rows.select(*[quoted(c) for c in target.columns])
    return target.unionByName(without_keys(rows, target, keys))


def update_matched(
    target: DataFrame,
    keys_frame: DataFrame,
    keys: Sequence[str],
    assignments: Mapping[str, Column],
    condition: Column | None = None,
) -> DataFrame:
    """Set columns on the rows of ``target`` that match a key and the condition.

    ``assignments`` and ``condition`` are written over the columns of ``target``;
    ``keys_frame`` must be unique per key.
    """
    marked = target.alias("t").join(
        keys_frame.select(*[quoted(k) for k in keys]).withColumn(MATCHED, F.lit(True)).alias("b"),
        key_match(keys, "t", "b"),
        "left",
    )
    hit = F.col(MATCHED).isNotNull()
    if condition is not None:
        hit = hit & condition
    columns = []
    for field in target.schema.fields:
        stored = F.col(f"t.{quoted(field.name)}")
        if field.name in assignments:
            value = assignments[field.name].cast(field.dataType)
            stored = F.when(hit, value).otherwise(stored)
        columns.append(stored.alias(field.name))
    return marked.select(*columns)


def merge_metrics(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows an upsert inserts, updates and writes."""
    stored = target.select(*[quoted(k) for k in keys]).withColumn(MATCHED, F.lit(True))
    marked = batch.select(*[quoted(k) for k in keys]).alias("b").join(
        stored.alias("t"), key_match(keys, "b", "t"), "left"
    )
    return marked.agg(
        F.count_if(F.col(MATCHED).isNull()).alias("rows_inserted"),
        F.count(MATCHED).alias("rows_updated"),
        F.count(F.lit(1)).alias("rows_written"),
    )
