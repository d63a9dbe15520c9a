"""Runs of the pipeline's steps: extract, ingest, check, version, publish."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.operators.quality import FAIL, orphans, run_checks
from siltstone.operators.scd2 import (
    dimension_schema,
    duplicate_keys,
    next_partitions,
    scd2_changes,
    scd2_missing,
)
from siltstone.plans.control import (
    CONFIGS,
    OPERATIONS,
    QUALITY_LOG,
    RUN_LOG,
    WATERMARKS,
    bootstrap,
    ensure_metadata,
    record_load,
    work_list,
)
from siltstone.plans.gold import Views
from siltstone.plans.profiles import current_profiles
from siltstone.session import stored
from siltstone.sinks.ledger import Ledger
from siltstone.sinks.logs import FAILED, SUCCESS, RunEntry, log_checks, log_run
from siltstone.sinks.publish import (
    Published,
    create_table,
    layout_of,
    new_snapshot_path,
    publish_table,
    swap_partitions,
    write_snapshot,
)
from siltstone.sinks.upsert import read_state
from siltstone.sources.incremental import land
from siltstone.sources.tables import preview, table_exists
from siltstone.specs import ForeignKey, Layers, Scd2Spec, TableSpec
from siltstone.streaming.ingest import ingest_all, record_sizes


class Source(Protocol):
    def read(self, spark: SparkSession, spec: TableSpec, watermark: str) -> DataFrame: ...


class QualityError(ValueError):
    """At least one check failed; ``failed`` holds the rows, ``samples`` some orphan keys."""

    def __init__(self, failed: Sequence, samples: Mapping[str, list]) -> None:
        self.failed, self.samples = list(failed), dict(samples)
        super().__init__(
            "; ".join(f"{c['table_name']} {c['check_name']}: {c['details']}" for c in failed)
        )


def extract_to_bronze(
    spark: SparkSession,
    layers: Layers,
    spec: TableSpec,
    source: Source,
    watermark: str,
    now: datetime | None = None,
) -> Published:
    """Land the rows past the watermark, then move it; a failure is recorded and raised.

    The watermark moves only after the files are complete. A crash in between lands the
    same rows again, which the keyed upsert absorbs.
    """
    now = now or datetime.now(timezone.utc)
    try:
        done = land(source.read(spark, spec, watermark), layers.bronze(spec), spec, now)
    except Exception:
        record_load(spark, layers, spec.name, FAILED, now=now)
        raise
    record_load(
        spark, layers, spec.name, SUCCESS, done.metrics.get("max_cdc"), done.rows, now
    )
    return done


def extract_all(
    spark: SparkSession,
    layers: Layers,
    specs: Sequence[TableSpec],
    source: Source,
    now: datetime | None = None,
) -> dict[str, Published]:
    """Extract every active table, one after the other, stopping at the first failure."""
    known = {spec.name: spec for spec in specs}
    tasks = work_list(
        spark.table(layers.metadata_table(CONFIGS)), spark.table(layers.metadata_table(WATERMARKS))
    ).collect()
    return {
        task["table_name"]: extract_to_bronze(
            spark, layers, known[task["table_name"]], source, task["watermark_date"], now
        )
        for task in tasks
        if task["table_name"] in known
    }


def run_quality(
    spark: SparkSession,
    layers: Layers,
    specs: Sequence[TableSpec],
    foreign_keys: Sequence[ForeignKey],
) -> list:
    """Run and log every check, then fail if one did; WARNING does not fail.

    Sizes and NULLs come from kept profiles, so only partitions written since the last check are read.
    """
    silver_names = {spec.name: layers.silver_table(spec.silver_table) for spec in specs}

    def read(table: str) -> DataFrame:
        return read_state(spark, silver_names[table])

    keys = {spec.name: spec.primary_keys for spec in specs}
    # One row per check comes back, not data.
    checks = run_checks(
        read,
        keys,
        foreign_keys,
        spark.table(layers.metadata_table(WATERMARKS)),
        "table_row_count",
        current_profiles(spark, layers, silver_names, keys),
    ).collect()
    log_checks(spark, layers.metadata_table(QUALITY_LOG), checks)
    failed = [check for check in checks if check["status"] == FAIL]
    if failed:
        broken = {(check["table_name"], check["check_name"]) for check in failed}
        samples = {
            f"{key.child}.{key.column}": [
                row["orphan_key"]
                for row in preview(orphans(read(key.child), read(key.parent), key)).collect()
            ]
            for key in foreign_keys
            if (key.child, f"referential_integrity_{key.column}") in broken
        }
        raise QualityError(failed, samples)
    return checks


STEP = "gold_scd2_merge"  # fixed value: the step's name in the run log
HISTORY = ("end_date",)


def history_table(spark: SparkSession, table: str, schema: StructType) -> None:
    """Create a dimension kept by ``end_date``, or lay out anew one that is not; empty ones are just declared."""
    if table_exists(spark, table):
        if layout_of(spark, table) != list(HISTORY):
            publish_table(stored(spark.table(table), "history"), table, HISTORY)
        return
    create_table(spark, table, schema, HISTORY)


def apply_scd2(
    spark: SparkSession,
    layers: Layers,
    spec: Scd2Spec,
    run_ts: datetime,
) -> int:
    """Bring one dimension up to date and return how many versions were added.

    Detection reads the open versions only, and the run rewrites those and adds the day's closed
    ones: partitions of earlier days keep their files. The changes are computed once and
    kept; without any, nothing is written.
    """
    table = layers.gold_table(spec.dimension)
    source = read_state(spark, layers.silver_table(spec.source))
    history_table(spark, table, dimension_schema(source.schema, spec))
    repeated = preview(duplicate_keys(source, spec.keys), 5).collect()
    if repeated:
        raise ValueError(f"{spec.source} repeats keys of {spec.dimension}: {repeated}")

    dimension = spark.table(table)
    open_rows = dimension.filter(F.col("end_date").isNull())
    changes = scd2_changes(open_rows, source, spec, run_ts).persist()
    missing = scd2_missing(open_rows, source, spec).persist() if spec.expire_missing else None
    try:
        count = changes.count()
        if count or missing is not None and not missing.isEmpty():
            rows = next_partitions(dimension, changes, spec, run_ts, missing)
            _publish_versions(spark, layers, table, rows, run_ts, count)
        return count
    finally:
        changes.unpersist()
        if missing is not None:
            missing.unpersist()


def _publish_versions(
    spark: SparkSession, layers: Layers, table: str, rows: DataFrame, run_ts: datetime, count: int
) -> None:
    # The day as the session sees it, as in the rows.
    day = spark.range(1).select(F.to_date(F.lit(run_ts).cast("timestamp")).cast("string")).first()[0]
    affected = {(None,), (day,)}
    closed = F.count_if(F.col("record_end_ts") == F.lit(run_ts).cast("timestamp"))
    done = write_snapshot(rows, new_snapshot_path(spark, table), HISTORY, {"rows_closed": closed})
    ledger = Ledger(spark, layers.metadata_table(OPERATIONS))
    operation = ledger.start(table, "VERSION", HISTORY, affected)
    swap_partitions(spark, table, HISTORY, done.location, affected)
    spark.catalog.refreshTable(table)
    ledger.finish(operation, done.location, count, count, int(done.metrics.get("rows_closed") or 0), done.rows)


def run_scd2(
    spark: SparkSession,
    layers: Layers,
    dimensions: Sequence[Scd2Spec],
    run_ts: datetime | None = None,
    run_id: str = "interactive",
) -> int:
    """Update all dimensions and log the run; returns the number of added versions."""
    ensure_metadata(spark, layers)
    names = ",".join(spec.dimension for spec in dimensions)
    run_ts = run_ts or datetime.now(timezone.utc)
    started = time.monotonic()

    def log(status: str, changed: int, error: str | None = None) -> None:
        entry = RunEntry(
            STEP, names, changed, changed, time.monotonic() - started,
            status, error, run_id=run_id,
        )
        log_run(spark, layers.metadata_table(RUN_LOG), entry)

    try:
        changed = sum(apply_scd2(spark, layers, spec, run_ts) for spec in dimensions)
    except Exception as error:
        log(FAILED, 0, str(error))
        raise
    log(SUCCESS, changed)
    return changed


def run_silver(
    spark: SparkSession,
    layers: Layers,
    specs: Sequence[TableSpec],
    foreign_keys: Sequence[ForeignKey] = (),
    run_id: str = "interactive",
) -> list:
    """Ingest all tables, check them, and note their sizes for the next drift check."""
    ensure_metadata(spark, layers)
    ingest_all(spark, specs, layers, run_id)
    checks = run_quality(spark, layers, specs, foreign_keys)
    record_sizes(spark, specs, layers)
    return checks


def run_all(
    spark: SparkSession,
    layers: Layers,
    specs: Sequence[TableSpec],
    source: Source,
    dimensions: Sequence[Scd2Spec],
    views: Views,
    foreign_keys: Sequence[ForeignKey] = (),
    run_ts: datetime | None = None,
    run_id: str = "interactive",
) -> dict[str, Published]:
    """One full run: extract, ingest, check, version the dimensions, publish the views."""
    bootstrap(spark, layers, specs, run_ts)
    extract_all(spark, layers, specs, source, run_ts)
    run_silver(spark, layers, specs, foreign_keys, run_id)
    run_scd2(spark, layers, dimensions, run_ts, run_id)
    return views.refresh(spark, layers)
