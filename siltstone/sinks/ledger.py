"""Operation ledger: what each publish and upsert did, and which partitions it touched.

Two rows per operation. ``STARTED`` is appended before a table moves to its new files and names the
partitions that may change, so readers of changes miss nothing even if the driver dies in between;
``DONE`` follows with the measured rows, and with the stream batch that was taken in.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sinks.publish import PartitionKey, append_table
from siltstone.sources.tables import inline_rows

# Partitioned by table, so the history of one table is read without the others.
OPERATIONS_DDL = (
    "operation_id STRING, version BIGINT, event_timestamp TIMESTAMP, operation STRING, state STRING, "
    "rows_read BIGINT, rows_inserted BIGINT, rows_updated BIGINT, rows_written BIGINT, location STRING, "
    "partitions ARRAY<STRING>, query_id STRING, batch_id BIGINT, table_name STRING"
)
PARTITIONED_BY = ("table_name",)
STARTED, DONE = "STARTED", "DONE"


@dataclass(frozen=True)
class Operation:
    """An operation under way; ``partitions`` None stands for the whole table."""

    operation_id: str
    version: int
    table: str
    name: str


@dataclass(frozen=True)
class Ledger:
    """The ledger table, and the stream batch whose rows are being taken in, if any."""

    spark: SparkSession
    name: str
    query_id: str | None = None
    batch_id: int | None = None

    def rows(self, table: str) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("table_name") == table.lower())

    def version(self, table: str) -> int:
        """Number of the last operation on a table, 0 if there was none."""
        return self.rows(table).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def start(
        self, table: str, operation: str, partition_by: Sequence[str] = (), keys: Iterable[PartitionKey] | None = None
    ) -> Operation:
        """Note an operation that is about to change the given partitions, or the whole table."""
        done = Operation(uuid.uuid4().hex, self.version(table) + 1, table.lower(), operation)
        named = None
        if keys is not None:
            named = sorted(json.dumps(dict(zip(partition_by, key)), sort_keys=True) for key in keys)
        self._append(done, STARTED, partitions=named)
        return done

    def finish(
        self, operation: Operation, location: str, rows_read: int, rows_inserted: int, rows_updated: int, rows_written: int
    ) -> None:
        """Note its outcome; ``rows_written`` counts rewritten neighbours as well."""
        self._append(
            operation, DONE, rows_read, rows_inserted, rows_updated, rows_written, location,
            query_id=self.query_id, batch_id=self.batch_id,
        )

    def _append(
        self,
        operation: Operation,
        state: str,
        rows_read: int | None = None,
        rows_inserted: int | None = None,
        rows_updated: int | None = None,
        rows_written: int | None = None,
        location: str | None = None,
        partitions: list[str] | None = None,
        query_id: str | None = None,
        batch_id: int | None = None,
    ) -> None:
        row = (
            operation.operation_id, operation.version, datetime.now(timezone.utc), operation.name, state,
            rows_read, rows_inserted, rows_updated, rows_written, location, partitions, query_id, batch_id,
            operation.table,
        )
        append_table(inline_rows(self.spark, [row], OPERATIONS_DDL), self.name, PARTITIONED_BY)

    def has_batch(self, table: str) -> bool:
        """Whether the batch of this ledger has been taken in already."""
        if self.query_id is None:
            return False
        same = (F.col("query_id") == self.query_id) & (F.col("batch_id") == self.batch_id)
        return not self.rows(table).filter((F.col("state") == DONE) & same).isEmpty()

    def touched(self, table: str, after: int, columns: Sequence[str]) -> set[PartitionKey] | None:
        """Values of ``columns`` in partitions that operations past version ``after`` may have changed.

        None if one of them replaced the whole table, or the table is laid out by other columns.
        """
        later = self.rows(table).filter((F.col("version") > after) & (F.col("state") == STARTED))
        if not later.filter(F.col("partitions").isNull()).isEmpty():
            return None
        # One text per partition comes back.
        named = [json.loads(r["p"]) for r in later.select(F.explode("partitions").alias("p")).distinct().collect()]
        if any(set(columns) - set(key) for key in named):
            return None
        return {tuple(key[c] for c in columns) for key in named}


def last_operation(ledger: DataFrame, tables: Sequence[str]) -> DataFrame:
    """The newest finished operation of each table: a top-1 per table, not a sort."""
    done = ledger.filter(F.col("table_name").isin([t.lower() for t in tables]) & (F.col("state") == DONE))
    columns = [c for c in ledger.columns if c not in ("table_name", "state", "partitions")]
    newest = F.max_by(F.struct(*columns), "version").alias("last")
    return done.groupBy("table_name").agg(newest).select("table_name", "last.*")
