"""Publish results as tables: write a fresh snapshot, then point the table at it.

A table is never overwritten in place. New files go to a folder of their own; only
after the write has succeeded and its expectations hold does the catalog entry (of the
table, or of each affected partition) move to them. Readers see whole versions, a
failed run leaves the table as it was, and a repeated run converges.

One writer per table at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import TYPE_CHECKING
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.operators.expectations import Expectation, ExpectationError, violation_columns
from siltstone.specs import quoted

if TYPE_CHECKING:
    from siltstone.sinks.ledger import Ledger

ROWS = "rows_total"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# The values of a partition as text, in the order of the partition columns.
PartitionKey = tuple[str | None, ...]


@dataclass(frozen=True)
class Published:
    location: str
    rows: int
    metrics: dict[str, object] = field(default_factory=dict)


def quoted_table(table: str) -> str:
    return ".".join(quoted(part) for part in table.split("."))


def create_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted_table(schema)}")


def create_table(
    spark: SparkSession,
    table: str,
    schema: StructType | str,
    partition_by: Sequence[str] = (),
    location: str | None = None,
    replace: bool = False,
) -> None:
    """Create a parquet table unless it exists; ``replace`` drops an existing one first.

    Every table has a location and so is external: dropping its entry leaves the files,
    which readers may still use, to ``sweep_snapshots``.
    Columns of a ``StructType`` become nullable: that one result had no NULL in a column
    says nothing about the next.
    """
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {quoted_table(table)}")
    if isinstance(schema, StructType):
        schema = ", ".join(
            f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields
        )
    parts = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    place = location or new_snapshot_path(spark, table)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted_table(table)} ({schema}) USING PARQUET{parts} LOCATION '{place}'"
    )


def table_root(spark: SparkSession, table: str) -> str:
    """Folder that holds a table's snapshots, below its schema's location."""
    *schema, name = table.split(".")
    database = spark.catalog.getDatabase(".".join(schema)) if schema else spark.catalog.getDatabase(
        spark.catalog.currentDatabase()
    )
    return f"{database.locationUri.rstrip('/')}/{name.lower()}_snapshots"


def write_snapshot(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    metrics: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
    options: Mapping[str, object] | None = None,
) -> Published:
    """Write a new parquet folder, measuring it in the same pass.

    Columns in ``drop`` can be measured but are not written.

    Partitioned output is rebalanced by its partition columns first: AQE then packs
    small partitions and splits hot ones, so each folder gets a few well-sized files.
    The measurement sits after that shuffle, in the stage that writes.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    measured = Observation()
    columns = {ROWS: F.count(F.lit(1)), **(metrics or {})}
    df = df.observe(measured, *[c.alias(name) for name, c in columns.items()]).drop(*drop)
    writer = df.write.options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    values = measured.get
    return Published(path, int(values.get(ROWS) or 0), values)


def new_snapshot_path(spark: SparkSession, table: str) -> str:
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S")
    return f"{table_root(spark, table)}/{stamp}_{uuid.uuid4().hex[:8]}"


def publish_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    expectations: Sequence[Expectation] = (),
    metrics: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
    ledger: Ledger | None = None,
) -> Published:
    """Replace the whole content of a table, creating it on first use.

    Violated expectations are counted while writing and abort before the swap. Columns that
    only came along are added; when columns have changed otherwise, or the partitions are by
    other columns, the table is declared anew. A ``ledger`` notes the operation.
    """
    spark = df.sparkSession
    checks = violation_columns(expectations)
    done = write_snapshot(
        df, new_snapshot_path(spark, table), partition_by, {**checks, **(metrics or {})}, drop
    )
    broken = {name: int(done.metrics[name]) for name in checks if done.metrics.get(name)}
    if broken:
        raise ExpectationError(table, broken)

    exists = spark.catalog.tableExists(table)
    operation = ledger.start(table, "REPLACE" if exists else "CREATE") if ledger else None
    point_table(df.drop(*drop), table, done, partition_by)
    if operation:
        ledger.finish(operation, done.location, done.rows, done.rows, 0, done.rows)
    return done


def point_table(written: DataFrame, table: str, done: Published, partition_by: Sequence[str] = ()) -> None:
    """Point a table at the snapshot ``done`` of ``written``, declaring it if it is new or its columns have changed."""
    spark = written.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists and not partition_by:
        known, wanted = set(spark.table(table).dtypes), dict(written.dtypes)
        names = {name.lower() for name, _ in known}
        added = [f for f in written.schema.fields if f.name.lower() not in names]
        if added and known | {(f.name, wanted[f.name]) for f in added} == set(wanted.items()):
            columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {quoted_table(table)} ADD COLUMNS ({columns})")
    changed = exists and sorted(spark.table(table).dtypes) != sorted(written.dtypes)
    if not exists or changed or not _laid_out_by(spark, table, partition_by):
        create_table(spark, table, written.schema, partition_by, done.location, replace=exists)
        if partition_by:
            spark.sql(f"MSCK REPAIR TABLE {quoted_table(table)}")
    elif partition_by:
        swap_partitions(spark, table, partition_by, done.location, table_partitions(spark, table))
    else:
        spark.sql(f"ALTER TABLE {quoted_table(table)} SET LOCATION '{done.location}'")
    spark.catalog.refreshTable(table)


def layout_of(spark: SparkSession, table: str) -> list[str]:
    """The columns a table is partitioned by."""
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _laid_out_by(spark: SparkSession, table: str, partition_by: Sequence[str]) -> bool:
    return [c.lower() for c in layout_of(spark, table)] == [c.lower() for c in partition_by]


def append_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a table, in files of their own."""
    df.write.mode("append").format("parquet").partitionBy(*partition_by).saveAsTable(table)


def _key_of(path: str, depth: int) -> PartitionKey:
    """Partition values from the last ``depth`` folder names ``column=value`` of a path."""
    values = [unquote(name.split("=", 1)[1]) for name in path.split("/")[-depth:]]
    return tuple(None if value == NULL_PARTITION else value for value in values)


def table_partitions(spark: SparkSession, table: str) -> set[PartitionKey]:
    """Partitions in the catalog."""
    rows = spark.sql(f"SHOW PARTITIONS {quoted_table(table)}").collect()
    return {_key_of(row["partition"], row["partition"].count("/") + 1) for row in rows}


def partition_keys(df: DataFrame, partition_by: Sequence[str]) -> set[PartitionKey]:
    """Partitions the rows belong to: at most as many values as there are partitions.

    Spark writes an empty text to the NULL partition, so it counts as NULL here.
    """
    text = df.select(*[F.nullif(F.col(quoted(c)).cast("string"), F.lit("")) for c in partition_by])
    return {tuple(row) for row in text.distinct().collect()}


def partition_filter(
    schema: StructType, partition_by: Sequence[str], keys: Iterable[PartitionKey]
) -> Column:
    """A filter on literal values, nested by column, that prunes at planning time."""
    column, *rest = partition_by
    cell, kind = F.col(quoted(column)), schema[column].dataType
    if not rest:
        values = {key[0] for key in keys}
        named = [F.lit(v).cast(kind) for v in sorted(v for v in values if v is not None)]
        test = cell.isin(*named) if named else F.lit(False)
        return test | cell.isNull() if None in values else test
    groups: dict[str | None, set[PartitionKey]] = {}
    for first, *others in keys:
        groups.setdefault(first, set()).add(tuple(others))
    test = F.lit(False)
    for value, others in groups.items():
        here = cell.isNull() if value is None else cell == F.lit(value).cast(kind)
        test = test | (here & partition_filter(schema, rest, others))
    return test


def _written_folders(spark: SparkSession, location: str, depth: int) -> dict[PartitionKey, str]:
    """Folder of each partition written at ``location``; the columns of the files do not matter here."""
    files = spark.read.schema("_ INT").parquet(location).inputFiles()
    # Names of files come URL-encoded, on top of the escapes in a partition's folder name.
    folders = {unquote(file).rsplit("/", 1)[0] for file in files}
    return {_key_of(folder, depth): folder for folder in folders}


def _clause(key: PartitionKey, partition_by: Sequence[str]) -> str:
    def literal(value: str | None) -> str:
        return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return ", ".join(f"{quoted(c)} = {literal(v)}" for c, v in zip(partition_by, key))


def _batches(clauses: list[str], size: int = 100) -> Iterable[list[str]]:
    return (clauses[start : start + size] for start in range(0, len(clauses), size))


def swap_partitions(
    spark: SparkSession,
    table: str,
    partition_by: Sequence[str],
    location: str,
    replaced: set[PartitionKey],
) -> None:
    """Point each partition written at ``location`` to its folder; drop the other ``replaced``.

    ``replaced`` are the partitions whose old rows are accounted for in the new ones.

    Receiving partitions move first. If the driver dies in between, a row that changed
    partition can be seen twice but never not at all, and repeating the batch repairs it.
    """
    name = quoted_table(table)
    folders = _written_folders(spark, location, len(partition_by))
    existing = table_partitions(spark, table)
    unplanned = (folders.keys() & existing) - replaced
    if unplanned:
        raise RuntimeError(f"{table}: would overwrite partitions not read before: {unplanned}")
    added = [
        f"PARTITION ({_clause(key, partition_by)}) LOCATION '{path}'"
        for key, path in folders.items()
        if key not in existing
    ]
    for some in _batches(added):
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(some)}")
    for key, path in folders.items():
        if key in existing:
            spark.sql(
                f"ALTER TABLE {name} PARTITION ({_clause(key, partition_by)}) SET LOCATION '{path}'"
            )
    gone = [f"PARTITION ({_clause(key, partition_by)})" for key in (replaced & existing) - folders.keys()]
    for some in _batches(gone):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(some)}")


def sweep_snapshots(
    spark: SparkSession, table: str, partition_by: Sequence[str] = (), min_age_hours: float = 24
) -> list[str]:
    """Delete folders of a table's former snapshots and return them.

    Kept are folders the table still reads and those younger than ``min_age_hours``,
    which running readers may need.
    """
    where = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_table(table)}")
    path = spark._jvm.org.apache.hadoop.fs.Path
    live = {path(where.filter("col_name = 'Location'").first()["data_type"]).toUri().getPath()}
    if partition_by:
        # One path per partition comes back; the scan reads no column.
        folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]+$", 1)
        rows = spark.table(table).select(folder.alias("folder")).distinct().collect()
        live |= {unquote(path(row["folder"]).toUri().getPath()) for row in rows}

    pattern = path(table_root(spark, table) + "/*" + "/*=*" * len(partition_by))
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    oldest_kept = (datetime.now(timezone.utc).timestamp() - min_age_hours * 3600) * 1000
    gone = [
        status.getPath()
        for status in system.globStatus(pattern) or []
        if status.getModificationTime() < oldest_kept
        and status.getPath().toUri().getPath() not in live
    ]
    for old in gone:
        system.delete(old, True)
    return [str(old.toString()) for old in gone]
