"""Bronze files to silver tables: conform, keep the latest row per key, upsert, log."""

from __future__ import annotations

import json
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from siltstone.functions.derive import conform
from siltstone.operators.keyed import latest_per_key, total_order
from siltstone.plans.control import OPERATIONS, RUN_LOG, record_table_sizes
from siltstone.sinks.ledger import Ledger
from siltstone.sinks.logs import FAILED, SUCCESS, RunEntry, log_run
from siltstone.sinks.upsert import Merged, reads_once, upsert_table
from siltstone.specs import Layers, TableSpec
from siltstone.streaming.paths import MAX_FILES_PER_BATCH, batch_paths, landed_paths
from siltstone.streaming.schema import pinned_schema, read_pinned

STEP = "silver_ingestion"  # fixed value: the step's name in the run log


def silver_rows(landed: DataFrame, spec: TableSpec) -> DataFrame:
    """Conformed rows, one per key."""
    return latest_per_key(
        conform(landed, spec.rules), spec.primary_keys, spec.order_column, spec.tie_breakers
    )


def ingest_rows(landed: DataFrame, spec: TableSpec, table: str, ledger: Ledger | None = None) -> Merged:
    """Upsert one batch of landed rows."""
    rows = silver_rows(landed, spec)
    if reads_once(landed.sparkSession, table, guarded=not spec.last_batch_wins):
        return _ingest_latest(rows, spec, table, ledger)
    rows = rows.persist()
    try:
        return _ingest_latest(rows, spec, table, ledger)
    finally:
        rows.unpersist()


def _ingest_latest(rows: DataFrame, spec: TableSpec, table: str, ledger: Ledger | None) -> Merged:
    return upsert_table(
        rows,
        table,
        spec.primary_keys,
        spec.partition_by,
        guard_order=None if spec.last_batch_wins else total_order(
            rows.schema, spec.primary_keys, spec.order_column, spec.tie_breakers
        ),
        stable_partitions=spec.stable_partitions,
        buckets=spec.key_buckets,
        ledger=ledger,
    )


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps as long as its checkpoint lasts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()["value"])["id"]


def ingest_batch(
    spark: SparkSession,
    spec: TableSpec,
    layers: Layers,
    batch: DataFrame,
    batch_id: int,
    query: str,
    run_id: str = "interactive",
) -> None:
    """Take one batch of landed paths into the silver table and log the outcome.

    The operation ledger notes the batch once its rows are published; a batch handed out again after a
    crash finds itself there and does nothing. One that died before is done again, which the
    keyed upsert absorbs.
    """
    started, rows_read, written = time.monotonic(), 0, 0
    table = layers.silver_table(spec.silver_table)
    ledger = Ledger(spark, layers.metadata_table(OPERATIONS), query, batch_id)

    def log(status: str, written: int, error: str | None = None) -> None:
        entry = RunEntry(
            STEP, spec.name, rows_read, written, time.monotonic() - started,
            status, error, str(batch_id), run_id,
        )
        log_run(spark, layers.metadata_table(RUN_LOG), entry)

    try:
        paths = batch_paths(batch)
        if not paths or ledger.has_batch(table):
            return
        pinned = pinned_schema(spark, layers.stream_state(spec, "schema"), paths)
        landed = read_pinned(spark, paths, pinned)
        # No column is needed for this count, so it reads the files' footers only.
        rows_read = landed.count()
        if rows_read or not spark.catalog.tableExists(table):
            written = ingest_rows(landed, spec, table, ledger).rows_written
        log(SUCCESS, written)
    except Exception as error:
        log(FAILED, 0, str(error))
        raise


def ingest_stream(
    spark: SparkSession,
    spec: TableSpec,
    layers: Layers,
    run_id: str = "interactive",
    max_files: int = MAX_FILES_PER_BATCH,
) -> None:
    """Ingest everything landed since the last run, then stop.

    The checkpoint hands out each file once, and :func:`ingest_batch` takes in each batch once. The
    outcome of every batch is logged, and a failure is logged and raised.
    """
    checkpoint = layers.stream_state(spec, "checkpoint")
    stream: list[str] = []

    def process(batch: DataFrame, batch_id: int) -> None:
        if not stream:  # written by the time of the first batch
            stream.append(query_id(spark, checkpoint))
        ingest_batch(spark, spec, layers, batch, batch_id, stream[0], run_id)

    query = (
        landed_paths(spark, layers.bronze(spec), max_files)
        .writeStream.queryName(f"silver_{spec.name.lower()}_available_now")
        .foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_all(
    spark: SparkSession, specs: Iterable[TableSpec], layers: Layers, run_id: str = "interactive"
) -> None:
    """Ingest table after table, stopping at the first that fails."""
    for spec in specs:
        ingest_stream(spark, spec, layers, run_id)


def record_sizes(spark: SparkSession, specs: Iterable[TableSpec], layers: Layers) -> None:
    """Note the size of each silver table for the next drift check."""
    sizes = {
        spec.name: spark.table(layers.silver_table(spec.silver_table)).count() for spec in specs
    }
    record_table_sizes(spark, layers, sizes)
