"""Incremental extract: rows past a watermark, landed as parquet and measured on the way."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StructType, TimestampType

from siltstone.sinks.publish import Published, write_snapshot
from siltstone.specs import TableSpec, quoted

# Bytes of a row group: a landed file is read by as many tasks as it has row groups, however few tasks wrote it.
LANDED_ROW_GROUP = 8 << 20
START_OF_TIME = "1900-01-01 00:00:00"


def split_column_of(schema: StructType, spec: TableSpec) -> str:
    """The column whose ranges split a table, by its spec or its first primary key."""
    column = spec.split_column or next(iter(spec.primary_keys), None)
    kinds = {f.name.lower(): f.dataType for f in schema.fields}
    kind = kinds.get((column or "").lower())
    if not isinstance(kind, (NumericType, DateType, TimestampType)):
        raise ValueError(
            f"{spec.name}: {column or 'no key'} cannot split the table; name a numeric or temporal "
            "split_column, or set single_task to read it in one task"
        )
    return column


# Ranks in the sketch of a split column are off by at most this share of a range.
DEPTH_ERROR = 0.02


def depth_bounds(df: DataFrame, column: str, ranges: int) -> list[object]:
    """Values that cut the rows into ``ranges`` of about equal size, ascending and distinct.

    They are quantiles of one mergeable sketch that tasks fill and the final one merges, so
    hot spots of the column get narrow ranges. A single value is never cut: one that holds
    several ranges' worth of rows closes one range, and there are fewer ranges then.
    """
    points = [k / ranges for k in range(1, ranges)]
    if not points:
        return []
    accuracy = max(10_000, int(ranges / DEPTH_ERROR))
    found = df.agg(F.percentile_approx(F.col(quoted(column)), points, accuracy)).first()[0]
    return sorted(set(found or []))


def _sql_literal(value: object) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"DATE '{value:%Y-%m-%d}'"
    return str(value)


def range_predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """One SQL condition per range; each row, also one without a value, meets exactly one."""
    if not bounds:
        return ["1 = 1"]
    texts = [_sql_literal(bound) for bound in bounds]
    inner = [f"{column} > {low} AND {column} <= {high}" for low, high in zip(texts, texts[1:])]
    return [f"{column} <= {texts[0]} OR {column} IS NULL", *inner, f"{column} > {texts[-1]}"]


@dataclass(frozen=True)
class JdbcSource:
    """A relational source. ``options`` are Spark's JDBC options (url, user, driver, ...).

    The changed rows of a table are read in ``num_partitions`` ranges of its split column, each
    by a predicate of its own. The ranges hold about as many rows each: the column alone is
    read first, in even steps between the least and greatest value of the changed rows, to
    find their bounds. The split column is the spec's ``split_column``, or else its first primary
    key if that is numeric or temporal. A table without one is only read, by one task, if its
    spec says ``single_task``.
    """

    options: Mapping[str, str]
    num_partitions: int = 64
    overlap: bool = False

    def read(self, spark: SparkSession, spec: TableSpec, watermark: str) -> DataFrame:
        options = {**self.options, "dbtable": f"{spec.schema_name}.{spec.name}"}
        table = spark.read.format("jdbc").options(**options).load()
        rows = changed_since(table, spec, watermark, self.overlap)
        if spec.single_task:
            return rows
        split_column = split_column_of(table.schema, spec)
        column = F.col(quoted(split_column))
        low, high = rows.agg(F.min(column), F.max(column)).first()
        if low is None:
            return rows
        ranges = spec.num_partitions or self.num_partitions
        even = {
            "partitionColumn": split_column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(ranges),
        }
        values = spark.read.format("jdbc").options(**options, **even).load()
        values = changed_since(values, spec, watermark, self.overlap).select(quoted(split_column))
        split = spark.read.jdbc(
            options["url"],
            options["dbtable"],
            predicates=range_predicates(split_column, depth_bounds(values, split_column, ranges)),
            properties={k: v for k, v in options.items() if k not in ("url", "dbtable")},
        )
        return changed_since(split, spec, watermark, self.overlap)


@dataclass(frozen=True)
class ParquetSource:
    """Source tables as parquet below ``root``, one file or folder per table."""

    root: str
    suffix: str = ""
    overlap: bool = False

    def read(self, spark: SparkSession, spec: TableSpec, watermark: str) -> DataFrame:
        table = spark.read.parquet(f"{self.root}/{spec.name}{self.suffix}")
        return changed_since(table, spec, watermark, self.overlap)


def changed_since(
    df: DataFrame, spec: TableSpec, watermark: str, overlap: bool = False
) -> DataFrame:
    """Rows whose change column is past the watermark, strictly.

    The literal takes the column's own type, so the comparison is pushed to the source.
    ``overlap`` also re-reads rows at the watermark itself; the upsert removes repeats.
    """
    column = F.col(quoted(spec.cdc_column))
    bound: Column = F.lit(watermark).cast("timestamp").cast(df.schema[spec.cdc_column].dataType)
    return df.filter(column >= bound if overlap else column > bound)


def slice_metrics(spec: TableSpec) -> dict[str, Column]:
    """New watermark and row count of an extracted slice."""
    return {
        "max_cdc": F.max(F.col(quoted(spec.cdc_column))).cast("timestamp"),
        "row_count": F.count(F.lit(1)),
    }


def measure(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.agg(*[c.alias(name) for name, c in slice_metrics(spec).items()])


def landing_path(bronze: str, spec: TableSpec, at: datetime | None = None) -> str:
    """``<bronze folder>/<table>_<yyyyMMddHHmmss>.parquet``, a folder of its own per run."""
    stamp = (at or datetime.now(timezone.utc)).strftime("%Y%m%d%H%M%S")
    return f"{bronze}/{spec.name.lower()}_{stamp}.parquet"


def land(
    df: DataFrame, bronze: str, spec: TableSpec, at: datetime | None = None
) -> Published:
    """Write the slice and return its path, row count and greatest change value.

    The files go to a folder of their own below the landing path, so a run that is
    repeated with the same time lands again beside the first.

    The measures come from the rows written, so nothing that reaches the source
    between copying and measuring can be skipped.
    """
    path = f"{landing_path(bronze, spec, at)}/{uuid.uuid4().hex[:12]}"
    return write_snapshot(
        df, path, metrics=slice_metrics(spec), options={"parquet.block.size": LANDED_ROW_GROUP}
    )
