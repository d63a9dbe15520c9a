"""Run log and quality log: append-only tables, their listings and the failure alert."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from siltstone.sinks.publish import append_table
from siltstone.sources.tables import inline_rows

# Columns of the logs.
RUN_LOG_DDL = (
    "event_timestamp TIMESTAMP, notebook_name STRING, table_name STRING, rows_read BIGINT, "
    "rows_written BIGINT, duration_seconds DOUBLE, status STRING, error_message STRING, "
    "batch_id STRING, run_id STRING"
)
QUALITY_LOG_DDL = (
    "check_timestamp TIMESTAMP, table_name STRING, check_name STRING, status STRING, details STRING"
)
SUCCESS, FAILED = "SUCCESS", "FAILED"


@dataclass(frozen=True)
class RunEntry:
    notebook_name: str
    table_name: str
    rows_read: int
    rows_written: int
    duration_seconds: float
    status: str
    error_message: str | None = None
    batch_id: str = "N/A"
    run_id: str = "interactive"


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


def log_run(
    spark: SparkSession, table: str, entry: RunEntry, at: datetime | None = None
) -> None:
    row = (
        at or _utc_now(),
        entry.notebook_name,
        entry.table_name,
        int(entry.rows_read),
        int(entry.rows_written),
        float(entry.duration_seconds),
        entry.status,
        entry.error_message,
        str(entry.batch_id),
        str(entry.run_id),
    )
    append_table(inline_rows(spark, [row], RUN_LOG_DDL), table)


def log_checks(
    spark: SparkSession, table: str, checks: Iterable[Row], at: datetime | None = None
) -> None:
    """Append all check rows of a run at once."""
    at = at or _utc_now()
    rows = [(at, c["table_name"], c["check_name"], c["status"], c["details"]) for c in checks]
    if rows:
        append_table(inline_rows(spark, rows, QUALITY_LOG_DDL), table)


def newest_first(df: DataFrame, column: str) -> DataFrame:
    """A listing of the whole table, newest entry first.

    The other columns order entries of the same time, which also lets the sort split
    a moment that holds very many of them.
    """
    rest = [F.col(c) for c in df.columns if c != column]
    return df.orderBy(F.col(column).desc(), *rest)


def recent_runs(log: DataFrame, limit: int = 1) -> DataFrame:
    """The last ``limit`` log entries (a top-k, not a full sort); ties by table and batch."""
    return log.orderBy(
        F.col("event_timestamp").desc(), F.col("table_name"), F.col("batch_id")
    ).limit(limit)


def failure_windows(
    log: DataFrame,
    width: str = "5 minutes",
    threshold: int = 0,
    watermark: str | None = None,
) -> DataFrame:
    """Tumbling windows with more than ``threshold`` failed runs.

    Counts are combined per task before the shuffle. For a streaming log give a
    ``watermark``, so that closed windows leave the state.
    """
    failed = log.filter(F.col("status") == FAILED)
    if watermark:
        failed = failed.withColumn(
            "event_timestamp", F.col("event_timestamp").cast("timestamp")
        ).withWatermark("event_timestamp", watermark)
    return (
        failed.groupBy(F.window("event_timestamp", width).alias("window"))
        .agg(F.count(F.lit(1)).alias("failed_runs"))
        .filter(F.col("failed_runs") > threshold)
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "failed_runs",
        )
    )


ALERT_DDL = "window_start TIMESTAMP, window_end TIMESTAMP"


def failure_alerts(
    log: DataFrame, width_minutes: int = 5, threshold: int = 0, keep: str = "30 days"
) -> DataFrame:
    """One row per window of a streamed log when it first has more than ``threshold`` failed runs, and never again.

    The state of a window is its count and whether it has raised its alert, so rows that come late
    count as well and a window alerts as soon as it passes, not when it closes. ``keep`` bounds the
    state: a window is forgotten when the newest failure is that much later, and rows older
    than that are passed over. Write the result in append mode.
    """
    failed = log.filter(F.col("status") == FAILED).select(F.col("event_timestamp").cast("timestamp").alias("at"))
    window = F.window("at", f"{width_minutes} minutes")
    failed = failed.withWatermark("at", keep).select("at", window["start"].alias("window_start"))

    def alert(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        count, raised = state.get if state.exists else (0, False)
        count += sum(len(rows) for rows in batches)
        end = key[0] + timedelta(minutes=width_minutes)
        if count > threshold and not raised:
            yield pd.DataFrame({"window_start": [key[0]], "window_end": [end]})
        state.update((count, raised or count > threshold))
        # Forgotten once the watermark has passed the window.
        state.setTimeoutTimestamp(max(int(end.timestamp() * 1000), state.getCurrentWatermarkMs() + 1))

    return failed.groupBy("window_start").applyInPandasWithState(
        alert, ALERT_DDL, "failed_runs BIGINT, raised BOOLEAN", "append", GroupStateTimeout.EventTimeTimeout
    )
