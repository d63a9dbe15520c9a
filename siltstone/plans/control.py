"""Control tables: which tables to load, how far they were loaded, and their logs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.keyed import insert_absent, upsert
from siltstone.sinks.ledger import OPERATIONS_DDL, PARTITIONED_BY
from siltstone.sinks.logs import QUALITY_LOG_DDL, RUN_LOG_DDL, SUCCESS
from siltstone.sinks.publish import create_schema, create_table, publish_table
from siltstone.sources.incremental import START_OF_TIME
from siltstone.sources.tables import inline_rows
from siltstone.specs import Layers, TableSpec

CONFIGS, WATERMARKS = "table_configs", "pipeline_watermarks"
RUN_LOG, QUALITY_LOG, OPERATIONS = "pipeline_logs", "data_quality_log", "table_operations"

VIEW_STATE, PROFILES = "view_state", "table_profiles"
PROFILE_DDL = (
    "partition_key STRING, version BIGINT, key_columns STRING, total_rows BIGINT, "
    "key_profiles ARRAY<STRUCT<`column`: STRING, null_rows: BIGINT, distinct_keys: BINARY>>, table_name STRING"
)
VIEW_STATE_DDL = "view_name STRING, version BIGINT"

CONFIG_DDL = "schema_name STRING, table_name STRING, cdc_column STRING, is_active BOOLEAN"
# last_row_count is the size of the last increment; table_row_count is the size of the
# silver table after its last successful ingest, which is what drift compares with.
WATERMARK_DDL = (
    "table_name STRING NOT NULL, last_load_timestamp TIMESTAMP, last_row_count BIGINT, "
    "load_status STRING, last_updated_at TIMESTAMP, table_row_count BIGINT"
)
WATERMARK_UPDATE_DDL = (
    "table_name STRING, last_load_timestamp TIMESTAMP, last_row_count BIGINT, load_status STRING"
)


def ensure_metadata(spark: SparkSession, layers: Layers) -> None:
    """Create the schemas of all layers and the control tables where absent."""
    for schema in layers.schemas():
        create_schema(spark, schema)
    for table, ddl in (
        (CONFIGS, CONFIG_DDL),
        (WATERMARKS, WATERMARK_DDL),
        (RUN_LOG, RUN_LOG_DDL),
        (QUALITY_LOG, QUALITY_LOG_DDL),
        (VIEW_STATE, VIEW_STATE_DDL),
    ):
        create_table(spark, layers.metadata_table(table), ddl)
    # By table, so that what concerns one is read and replaced without the others.
    for table, ddl in ((OPERATIONS, OPERATIONS_DDL), (PROFILES, PROFILE_DDL)):
        create_table(spark, layers.metadata_table(table), ddl, PARTITIONED_BY)


def config_rows(spark: SparkSession, specs: Iterable[TableSpec]) -> DataFrame:
    rows = [(s.schema_name, s.name, s.cdc_column, s.is_active) for s in specs]
    return inline_rows(spark, rows, CONFIG_DDL)


def config_upsert(configs: DataFrame, incoming: DataFrame) -> DataFrame:
    """State of the configs after an upsert; a table that comes again becomes active."""
    return upsert(configs, incoming.withColumn("is_active", F.lit(True)), ["table_name"])


def seed_watermarks(watermarks: DataFrame, names: DataFrame, now: datetime | str) -> DataFrame:
    """Add a pending watermark at the start of time for tables that have none."""
    seeds = names.select(
        "table_name",
        F.lit(START_OF_TIME).cast("timestamp").alias("last_load_timestamp"),
        F.lit(0).cast("bigint").alias("last_row_count"),
        F.lit("PENDING").alias("load_status"),
        F.lit(now).cast("timestamp").alias("last_updated_at"),
    )
    missing = [f for f in watermarks.schema.fields if f.name not in seeds.columns]
    seeds = seeds.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    return insert_absent(watermarks, seeds, ["table_name"])


def watermark_upsert(watermarks: DataFrame, updates: DataFrame, now: datetime | str) -> DataFrame:
    """Apply load outcomes, unique per table.

    A stored timestamp or count changes only on SUCCESS and only to a non-NULL value,
    each on its own; status and update time always change. A table seen for the first
    time keeps its values only on SUCCESS.
    """
    given = updates.select(
        "table_name",
        F.col("last_load_timestamp").alias("_ts"),
        F.col("last_row_count").alias("_count"),
        F.col("load_status").alias("_status"),
    )
    joined = watermarks.withColumn("_stored", F.lit(True)).join(given, "table_name", "full_outer")
    updated = F.col("_status").isNotNull()
    succeeded = F.col("_status") == SUCCESS
    columns = {
        "last_load_timestamp": F.when(
            succeeded, F.coalesce("_ts", "last_load_timestamp")
        ).otherwise(F.col("last_load_timestamp")),
        "last_row_count": F.when(
            succeeded, F.coalesce("_count", "last_row_count")
        ).otherwise(F.col("last_row_count")),
        "load_status": F.when(updated, F.col("_status")).otherwise(F.col("load_status")),
        "last_updated_at": F.when(updated, F.lit(now).cast("timestamp")).otherwise(
            F.col("last_updated_at")
        ),
    }
    return joined.withColumns(columns).select(*watermarks.columns)


def work_list(configs: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Active tables with their watermark as text, ordered by name."""
    return (
        configs.filter(F.col("is_active"))
        .join(watermarks.select("table_name", "last_load_timestamp"), "table_name", "left")
        .select(
            "schema_name",
            "table_name",
            "cdc_column",
            F.date_format(
                F.coalesce(
                    F.col("last_load_timestamp"), F.lit(START_OF_TIME).cast("timestamp")
                ),
                "yyyy-MM-dd HH:mm:ss",
            ).alias("watermark_date"),
        )
        .orderBy("table_name")
    )


def bootstrap(
    spark: SparkSession, layers: Layers, specs: Iterable[TableSpec], now: datetime | None = None
) -> None:
    """Create the control tables and register the given tables in them; safe to repeat."""
    ensure_metadata(spark, layers)
    configs, watermarks = layers.metadata_table(CONFIGS), layers.metadata_table(WATERMARKS)
    incoming = config_rows(spark, specs)
    stored = config_upsert(spark.table(configs), incoming.filter("is_active"))
    retired = incoming.filter("NOT is_active")
    publish_table(upsert(stored, retired, ["table_name"]), configs)
    now = now or datetime.now(timezone.utc)
    publish_table(seed_watermarks(spark.table(watermarks), incoming, now), watermarks)


def record_load(
    spark: SparkSession,
    layers: Layers,
    table: str,
    status: str,
    last_load_timestamp: datetime | None = None,
    last_row_count: int | None = None,
    now: datetime | None = None,
) -> None:
    """Store the outcome of one load."""
    watermarks = layers.metadata_table(WATERMARKS)
    update = inline_rows(
        spark, [(table, last_load_timestamp, last_row_count, status)], WATERMARK_UPDATE_DDL
    )
    now = now or datetime.now(timezone.utc)
    publish_table(watermark_upsert(spark.table(watermarks), update, now), watermarks)


def record_table_sizes(spark: SparkSession, layers: Layers, sizes: Mapping[str, int]) -> None:
    """Store the row counts of silver tables for the next drift check."""
    watermarks = layers.metadata_table(WATERMARKS)
    given = inline_rows(spark, sizes.items(), "table_name STRING, _rows BIGINT")
    stored = spark.table(watermarks)
    updated = stored.join(given, "table_name", "left").withColumn(
        "table_row_count", F.coalesce("_rows", "table_row_count")
    )
    publish_table(updated.select(*stored.columns), watermarks)
