"""Slowly changing dimensions of type 2: detect by hash, expire, append."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from siltstone.functions.hashing import hash_key
from siltstone.operators.keyed import key_match, update_matched, without_keys
from siltstone.session import stored
from siltstone.specs import Scd2Spec, quoted


def attribute_hash(df: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Add ``attribute_hash`` over the tracked columns."""
    return df.withColumn("attribute_hash", hash_key(*spec.tracked, null_token=spec.null_token))


def dimension_schema(source: StructType, spec: Scd2Spec) -> StructType:
    """Schema of the dimension, taking business columns' types from the source."""
    carried = {target: column for column, target in spec.carried.items()}
    fixed = {
        spec.surrogate: StringType(),
        "start_date": DateType(),
        "end_date": DateType(),
        "is_current": BooleanType(),
        "attribute_hash": StringType(),
        "record_start_ts": TimestampType(),
        "record_end_ts": TimestampType(),
    }
    return StructType(
        [
            StructField(name, fixed.get(name) or source[carried.get(name, name)].dataType)
            for name in spec.columns
        ]
    )


def _renamed(source: DataFrame, spec: Scd2Spec) -> DataFrame:
    return attribute_hash(source, spec).select(
        *[quoted(c) for c in (*spec.keys, *spec.tracked)],
        *[F.col(quoted(column)).alias(target) for column, target in spec.carried.items()],
        "attribute_hash",
    )


def _stamps(run_ts: datetime | str, run_date: date | str | None) -> tuple[Column, Column]:
    stamp = F.lit(run_ts).cast("timestamp")
    return stamp, (F.to_date(stamp) if run_date is None else F.lit(run_date).cast("date"))


def _version_columns(spec: Scd2Spec, stamp: Column, day: Column) -> dict[str, Column]:
    return {
        "start_date": day,
        "end_date": F.lit(None).cast("date"),
        "is_current": F.lit(True),
        "record_start_ts": stamp,
        "record_end_ts": F.lit(None).cast("timestamp"),
        spec.surrogate: hash_key(*spec.keys, stamp),
    }


def _fitted(rows: DataFrame, dimension: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Columns in the dimension's order and types."""
    return rows.select(
        *[F.col(quoted(c)).cast(dimension.schema[c].dataType).alias(c) for c in spec.columns]
    )


def _current(dimension: DataFrame) -> DataFrame:
    return dimension.filter(F.col("is_current"))


def _past(dimension: DataFrame) -> DataFrame:
    return dimension.filter(~F.coalesce(F.col("is_current"), F.lit(False)))


def scd2_changes(
    dimension: DataFrame,
    source: DataFrame,
    spec: Scd2Spec,
    run_ts: datetime | str,
    run_date: date | str | None = None,
) -> DataFrame:
    """New versions: source rows whose key is unknown or whose hash differs.

    Only key and hash of the current rows take part in the join.
    """
    stamp, day = _stamps(run_ts, run_date)
    known = _current(dimension).select(*[quoted(k) for k in spec.keys], "attribute_hash")
    first = quoted(spec.keys[0])
    changed = (
        _renamed(source, spec)
        .alias("s")
        .join(known.alias("t"), key_match(spec.keys, "s", "t"), "left")
        .where(
            F.col(f"t.{first}").isNull() | (F.col("s.attribute_hash") != F.col("t.attribute_hash"))
        )
        .select("s.*")
        .withColumns(_version_columns(spec, stamp, day))
    )
    return _fitted(changed, dimension, spec)


def scd2_missing(dimension: DataFrame, source: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Keys of current rows that the source no longer has."""
    keys = [quoted(k) for k in spec.keys]
    return without_keys(_current(dimension).select(*keys).dropna(), source, spec.keys)


def scd2_merge(
    dimension: DataFrame,
    changes: DataFrame,
    spec: Scd2Spec,
    run_ts: datetime | str,
    run_date: date | str | None = None,
    missing: DataFrame | None = None,
) -> DataFrame:
    """Expire the current rows of changed and ``missing`` keys and append the new versions.

    Give persisted ``changes``, since they are used twice. History passes through
    untouched, and when few keys changed they are broadcast, so nothing of the
    dimension is shuffled.
    """
    stamp, day = _stamps(run_ts, run_date)
    closing = changes.select(*[quoted(k) for k in spec.keys])
    if missing is not None:
        closing = closing.unionByName(missing.select(*[quoted(k) for k in spec.keys]))
    ended = {"end_date": day, "is_current": F.lit(False), "record_end_ts": stamp}
    expired = update_matched(_current(dimension), closing.distinct(), spec.keys, ended)
    if missing is not None:
        # A NULL key matches no source row either.
        null_key = reduce(Column.__or__, [F.col(quoted(k)).isNull() for k in spec.keys])
        expired = expired.withColumns(
            {c: F.when(null_key, value).otherwise(F.col(c)) for c, value in ended.items()}
        )
    return _past(dimension).unionByName(expired).unionByName(changes)


def scd2_apply(
    dimension: DataFrame,
    source: DataFrame,
    spec: Scd2Spec,
    run_ts: datetime | str,
    run_date: date | str | None = None,
) -> DataFrame:
    """Next state of the dimension: detection, then the merge that a run publishes.

    Changed and missing keys are stored once, as both are used more than once.
    """
    changes = stored(scd2_changes(dimension, source, spec, run_ts, run_date), "changes")
    missing = stored(scd2_missing(dimension, source, spec), "missing") if spec.expire_missing else None
    return scd2_merge(dimension, changes, spec, run_ts, run_date, missing)


def next_partitions(
    dimension: DataFrame,
    changes: DataFrame,
    spec: Scd2Spec,
    run_ts: datetime | str,
    missing: DataFrame | None = None,
) -> DataFrame:
    """What a run writes of a dimension kept by ``end_date``: its open rows and those closed on the day.

    Open versions are the NULL partition, and each day's closed versions a partition that later
    runs leave alone. Rows closed earlier the same day are kept; one that is still open as well was
    written by a run that died before it moved the open rows, and is closed again.
    """
    _, day = _stamps(run_ts, None)
    open_rows = dimension.filter(F.col("end_date").isNull())
    same = open_rows.select(quoted(spec.surrogate))
    closed = dimension.filter(F.col("end_date") == day).join(same, spec.surrogate, "left_anti")
    merged = scd2_merge(open_rows, changes, spec, run_ts, missing=missing)
    return merged.unionByName(closed.select(*[quoted(c) for c in merged.columns]))


def duplicate_keys(source: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once; applying a dimension needs this to be empty."""
    return (
        source.dropna(subset=list(keys))
        .groupBy(*[F.col(quoted(k)) for k in keys])
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter("row_count > 1")
    )
