"""Every operator as a query over the given tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from registered.relations import (
    EVENTS,
    FIRST_RUN,
    LINE_KEYS,
    LINE_TIES,
    LINES,
    ORDERS,
    RUN_TS,
    Tables,
)
from siltstone.functions.derive import conform
from siltstone.operators import keyed, quality
from siltstone.operators.expectations import Expectation, require, violations
from siltstone.operators.joins import join_chain
from siltstone.operators.keyed import (
    latest_per_key,
    newer_than_stored,
    update_matched,
    upsert,
)
from siltstone.operators.scd2 import attribute_hash, scd2_apply, scd2_changes
from siltstone.plans import control, listening, runs
from siltstone.plans.listening import ARTIST_DIMENSION, FOREIGN_KEYS, RULES, USER_DIMENSION, VIEWS
from siltstone.plans.profiles import current_profiles
from siltstone.session import fresh_dir, stored, tune
from siltstone.sinks.ledger import Ledger, last_operation
from siltstone.sinks.logs import (
    ALERT_DDL,
    failure_alerts,
    failure_windows,
    newest_first,
    recent_runs,
)
from siltstone.sinks.publish import publish_table
from siltstone.sinks.upsert import read_state, upsert_table
from siltstone.sources.incremental import (
    ParquetSource,
    changed_since,
    depth_bounds,
    land,
    measure,
    range_predicates,
)
from siltstone.sources.tables import inline_rows
from siltstone.specs import JoinSpec, Layers, TableSpec, table_specs
from siltstone.streaming.ingest import ingest_batch, ingest_stream, query_id
from siltstone.streaming.schema import read_pinned

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
WATERMARK = "1998-01-01 00:00:00"


def registered(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Tables(tune(spark), sf_dir))

    QUERIES[build.__name__] = run
    return build


def own_layers(t: Tables) -> Layers:
    """Schemas of this run alone, kept in the shared folder."""
    tag = uuid.uuid4().hex[:8]
    root = fresh_dir(t.spark, "run")
    layers = Layers(root, f"silver_{tag}", f"gold_{tag}", f"metadata_{tag}")
    for schema in layers.schemas():
        t.spark.sql(f"CREATE SCHEMA {schema} LOCATION '{root}/{schema}'")
    control.ensure_metadata(t.spark, layers)
    return layers


# Sources, watermarks and control tables


@registered
def incremental_extract(t: Tables) -> DataFrame:
    return changed_since(t("orders"), ORDERS, WATERMARK)


@registered
def extract_watermark(t: Tables) -> DataFrame:
    return measure(changed_since(t("orders"), ORDERS, WATERMARK), ORDERS)


@registered
def equal_depth_ranges(t: Tables) -> DataFrame:
    """Orders cut into sixteen ranges by price, as a relational source would be read."""
    orders = t("orders")
    predicates = range_predicates("o_totalprice", depth_bounds(orders, "o_totalprice", 16))
    counts = [F.count_if(F.expr(p)) for p in predicates]
    return orders.agg(
        F.lit(len(predicates)).alias("ranges"),
        F.count(F.lit(1)).alias("orders"),
        reduce(lambda a, b: a + b, counts).alias("in_ranges"),
        (F.greatest(*counts) <= 2 * F.least(*counts)).alias("within_two"),
    )


@registered
def extract_to_bronze(t: Tables) -> DataFrame:
    """Load log after extracting two source tables three times, the later ones finding nothing."""
    layers = own_layers(t)
    source = ParquetSource(t.sf_dir, ".parquet")
    control.bootstrap(t.spark, layers, [ORDERS, EVENTS])
    # The last run repeats the first one's time.
    for second in (0, 1, 0):
        runs.extract_all(
            t.spark, layers, [ORDERS, EVENTS], source, datetime(2026, 3, 31, 6, 57, second)
        )
    landed = [
        t.spark.read.option("recursiveFileLookup", "true")
        .parquet(layers.bronze(spec))
        .agg(F.lit(spec.name).alias("table_name"), F.count(F.lit(1)).alias("landed_rows"))
        for spec in (ORDERS, EVENTS)
    ]
    return (
        t.spark.table(layers.metadata_table(control.WATERMARKS))
        .select("table_name", "last_load_timestamp", "last_row_count", "load_status")
        .join(landed[0].unionByName(landed[1]), "table_name")
    )


@registered
def ingest_work_list(t: Tables) -> DataFrame:
    return control.work_list(t.configs().drop("c_acctbal"), t.watermarks())


@registered
def watermark_upsert(t: Tables) -> DataFrame:
    updates = t.loads("O").select(
        "table_name",
        F.when(F.col("orders") > 1, F.col("newest")).alias("last_load_timestamp"),
        F.when(F.col("orders") != 2, F.col("orders")).alias("last_row_count"),
        F.when(F.col("largest") > 400000, F.lit("FAILED"))
        .otherwise(F.lit("SUCCESS"))
        .alias("load_status"),
    )
    return control.watermark_upsert(t.watermarks(), updates, RUN_TS)


CONFIG = """{"tables": [
  {"table_name": "orders", "source_schema": "shop", "cdc_column": "o_orderdate", "primary_keys": ["o_orderkey"]},
  {"table_name": "lineitem", "cdc_column": "l_shipdate", "primary_keys": ["l_orderkey", "l_linenumber"]},
  {"table_name": "events", "cdc_column": "ts", "primary_keys": ["event_id"], "deduplicate_order_column": "value"}
]}"""


@registered
def config_specs(t: Tables) -> DataFrame:
    """Tables declared as JSON text, measured by their declarations."""
    rows = []
    for spec in table_specs(json.loads(CONFIG)["tables"]):
        table = t(spec.name)
        measured = table.agg(
            F.max(F.col(spec.cdc_column)).cast("timestamp").alias("newest"),
            F.count_distinct(*spec.primary_keys).alias("distinct_keys"),
        )
        named = {"table_name": spec.name, "schema_name": spec.schema_name, "order_column": spec.order_column}
        rows.append(measured.select(*[F.lit(v).alias(k) for k, v in named.items()], "newest", "distinct_keys"))
    return reduce(DataFrame.unionByName, rows)


@registered
def seed_upsert(t: Tables) -> DataFrame:
    """Inline rows merged into a given table: one replaces a region, one is new."""
    seeds = inline_rows(t.spark, [(1, "AMERICAS"), (9, "ATLANTIS")], "r_regionkey INT, r_name STRING")
    return upsert(t("region").select("r_regionkey", "r_name"), seeds, ["r_regionkey"])


@registered
def config_upsert(t: Tables) -> DataFrame:
    stored = t.configs().filter("c_acctbal < 5000").drop("c_acctbal")
    incoming = t.configs().filter("c_acctbal > -500").drop("c_acctbal")
    return control.config_upsert(stored, incoming.withColumn("cdc_column", F.lit("o_orderkey")))


@registered
def seed_absent_watermarks(t: Tables) -> DataFrame:
    return control.seed_watermarks(t.watermarks(), t.configs(), RUN_TS)


# Conforming, deduplication, upserts


@registered
def conform_user(t: Tables) -> DataFrame:
    return conform(t.users(), RULES["DimUser"])


@registered
def conform_track(t: Tables) -> DataFrame:
    return conform(t.tracks(), RULES["DimTrack"])


@registered
def conform_fact(t: Tables) -> DataFrame:
    return conform(t.streams(), RULES["FactStream"])


@registered
def latest_lineitem(t: Tables) -> DataFrame:
    return latest_per_key(t("lineitem"), LINE_KEYS, "l_shipdate", LINE_TIES)


@registered
def latest_order_per_customer(t: Tables) -> DataFrame:
    return latest_per_key(t("orders"), ("o_custkey",), "o_orderdate", ("o_orderkey",))


def _latest_lines(t: Tables, status: str) -> DataFrame:
    return latest_per_key(t.lines(status), LINE_KEYS, "l_shipdate", LINE_TIES)


@registered
def keyed_upsert(t: Tables) -> DataFrame:
    return upsert(_latest_lines(t, "F"), stored(_latest_lines(t, "O"), "batch"), LINE_KEYS)


@registered
def keyed_upsert_guarded(t: Tables) -> DataFrame:
    target = stored(_latest_lines(t, "F"), "target")
    batch = stored(_latest_lines(t, "O"), "batch")
    accepted = stored(newer_than_stored(target, batch, LINE_KEYS, "l_shipdate"), "accepted")
    return upsert(target, accepted, LINE_KEYS)


@registered
def merge_metrics(t: Tables) -> DataFrame:
    return keyed.merge_metrics(_latest_lines(t, "F"), _latest_lines(t, "O"), LINE_KEYS)


@registered
def expire_matched(t: Tables) -> DataFrame:
    """Close the open orders of customers in debt; no row is inserted."""
    debtors = t("customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return update_matched(
        t("orders"),
        debtors,
        ["o_custkey"],
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.lit(0.0)},
        F.col("o_orderstatus") == "O",
    )


@registered
def upsert_moves_partition(t: Tables) -> DataFrame:
    """A table partitioned by ship year, whose rows may change year in the second batch."""
    layers = own_layers(t)
    table = layers.silver_table("lines")
    for status in ("F", "O"):
        batch = _latest_lines(t, status).withColumn("ship_year", F.year("l_shipdate")).persist()
        upsert_table(batch, table, LINE_KEYS, ["ship_year"])
        batch.unpersist()
    return t.spark.table(table)


@registered
def upsert_bucketed(t: Tables) -> DataFrame:
    """A table laid out by key buckets, of which a second batch of some keys hits a few, and a third all."""
    layers = own_layers(t)
    table = layers.silver_table("lines")
    incoming = stored(_latest_lines(t, "O"), "incoming")
    newest = incoming.agg(F.max("l_shipdate")).first()[0]
    for batch in (_latest_lines(t, "F"), incoming.filter(F.col("l_shipdate") == newest), incoming):
        upsert_table(batch.persist(), table, LINE_KEYS, buckets=16)
        batch.unpersist()
    return read_state(t.spark, table)


@registered
def last_operation_metrics(t: Tables) -> DataFrame:
    """What the ledger says of the last of two upserts into one table, and of a single one into another."""
    layers = own_layers(t)
    ledger = Ledger(t.spark, layers.metadata_table(control.OPERATIONS))
    tables = [layers.silver_table(name) for name in ("lines", "closed_lines")]
    for table, status in ((tables[0], "F"), (tables[1], "F"), (tables[0], "O")):
        batch = _latest_lines(t, status).persist()
        upsert_table(batch, table, LINE_KEYS, buckets=8, ledger=ledger)
        batch.unpersist()
    return last_operation(t.spark.table(ledger.name), tables).select(
        F.regexp_extract("table_name", "[^.]+$", 0).alias("table_name"), "version", "operation",
        "rows_read", "rows_inserted", "rows_updated",
    )


@registered
def stream_upsert(t: Tables) -> DataFrame:
    """Two landings streamed into a silver table, the later one winning."""
    layers, spec = own_layers(t), replace(LINES, last_batch_wins=True)
    for second, status in enumerate(("F", "O")):
        land(t.lines(status), layers.bronze(spec), spec, datetime(2026, 3, 31, 6, 57, second))
        ingest_stream(t.spark, spec, layers)
    return t.spark.table(layers.silver_table(spec.name))


@registered
def stream_replayed(t: Tables) -> DataFrame:
    """Run log and ledger of a table whose only batch is handed out three times."""
    layers = own_layers(t)
    land(t.lines("F"), layers.bronze(LINES), LINES, datetime(2026, 3, 31, 6, 57, 0))
    ingest_stream(t.spark, LINES, layers)
    files = t.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    batch = files.load(layers.bronze(LINES)).select("path")
    query = query_id(t.spark, layers.stream_state(LINES, "checkpoint"))
    for _ in range(2):
        ingest_batch(t.spark, LINES, layers, batch, 0, query)
    ledger = Ledger(t.spark, layers.metadata_table(control.OPERATIONS))
    snapshots = ledger.rows(layers.silver_table(LINES.name)).agg(F.count_distinct("location")).first()[0]
    log = t.spark.table(layers.metadata_table(control.RUN_LOG))
    log = log.select("table_name", "rows_read", "rows_written", "status", "batch_id")
    return log.withColumn("snapshots", F.lit(snapshots))


@registered
def stream_batch_cuts(t: Tables) -> DataFrame:
    """The newer lines land first and every file is a batch; the newest row of a key wins."""
    layers = own_layers(t)
    for second, status in enumerate(("O", "F")):
        lines = t.lines(status).coalesce(2)
        land(lines, layers.bronze(LINES), LINES, datetime(2026, 3, 31, 6, 57, second))
    ingest_stream(t.spark, LINES, layers, max_files=1)
    return t.spark.table(layers.silver_table(LINES.name))


@registered
def stream_schema_guard(t: Tables) -> DataFrame:
    """Run log of an ingest whose second landing brings an unknown column."""
    layers = own_layers(t)
    land(t.lines("F"), layers.bronze(LINES), LINES, datetime(2026, 3, 31, 6, 57, 0))
    ingest_stream(t.spark, LINES, layers)
    wider = t.lines("O").withColumn("l_note", F.lit("new"))
    land(wider, layers.bronze(LINES), LINES, datetime(2026, 3, 31, 6, 57, 1))
    try:
        ingest_stream(t.spark, LINES, layers)
        raise AssertionError("the new column was not noticed")
    except Exception as error:
        if "l_note" not in str(error):
            raise
    log = t.spark.table(layers.metadata_table(control.RUN_LOG))
    return log.select(
        "table_name", "rows_read", "rows_written", "status",
        F.coalesce(F.col("error_message").contains("l_note"), F.lit(False)).alias("names_column"),
    )


@registered
def rescued_rows(t: Tables) -> DataFrame:
    """Open orders are landed with text customer keys, which do not all fit the pinned type."""
    root = fresh_dir(t.spark, "rescue")
    orders = t("orders")
    orders.filter("o_orderstatus <> 'O'").write.parquet(f"{root}/plain")
    text = F.when(F.col("o_totalprice") > 250000, F.concat(F.lit("C"), F.col("o_custkey")))
    orders.filter("o_orderstatus = 'O'").withColumn(
        "o_custkey", F.coalesce(text, F.col("o_custkey").cast("string"))
    ).write.parquet(f"{root}/drifted")
    return read_pinned(t.spark, [f"{root}/plain", f"{root}/drifted"], orders.schema)


@registered
def rescued_lossy(t: Tables) -> DataFrame:
    """Events landed with wider types than are pinned: casts that lose something are rescued."""
    root = fresh_dir(t.spark, "rescue")
    t("events").select(
        "event_id", "ts", "value", F.col("value").cast("decimal(14,3)").alias("amount")
    ).write.parquet(f"{root}/wide")
    pinned = StructType.fromDDL("event_id BIGINT, ts DATE, value BIGINT, amount DECIMAL(14,1)")
    rescued = F.coalesce(F.col("_rescued_data"), F.lit(""))
    return read_pinned(t.spark, [f"{root}/wide"], pinned).select(
        "event_id", "ts", "value", F.col("amount").cast("double").alias("amount"),
        *[rescued.contains(f'"{c}":').alias(f"{c}_rescued") for c in ("ts", "value", "amount")],
    )


# Versioned dimensions


@registered
def user_attribute_hash(t: Tables) -> DataFrame:
    return attribute_hash(t.users(), USER_DIMENSION).select("user_id", "attribute_hash")


@registered
def artist_attribute_hash(t: Tables) -> DataFrame:
    return attribute_hash(t.artists(), ARTIST_DIMENSION).select("artist_id", "attribute_hash")


@registered
def scd2_changes_user(t: Tables) -> DataFrame:
    return scd2_changes(t.first_dimension(USER_DIMENSION), t.users(), USER_DIMENSION, RUN_TS)


@registered
def scd2_changes_artist(t: Tables) -> DataFrame:
    return scd2_changes(
        t.first_dimension(ARTIST_DIMENSION), t.artists(), ARTIST_DIMENSION, RUN_TS
    )


@registered
def scd2_user(t: Tables) -> DataFrame:
    return t.dimension(USER_DIMENSION)


@registered
def scd2_artist(t: Tables) -> DataFrame:
    return t.dimension(ARTIST_DIMENSION)


@registered
def scd2_second_run_noop(t: Tables) -> DataFrame:
    """Applying the same source again adds and expires nothing."""
    return scd2_apply(
        t.dimension(USER_DIMENSION), t.users(), USER_DIMENSION, "2026-04-30 00:00:00"
    )


@registered
def scd2_published(t: Tables) -> DataFrame:
    """The user dimension kept as a table over two runs and a third without changes."""
    layers = own_layers(t)
    silver = layers.silver_table("DimUser")
    for stamp, users in (
        (FIRST_RUN, t.earlier_users()),
        (RUN_TS, t.users()),
        ("2026-04-30 00:00:00", t.users()),
    ):
        publish_table(users, silver)
        runs.run_scd2(t.spark, layers, [USER_DIMENSION], datetime.fromisoformat(stamp))
    return t.spark.table(layers.gold_table(USER_DIMENSION.dimension))


@registered
def scd2_published_missing(t: Tables) -> DataFrame:
    """The user dimension over two runs, the second with fewer users, whose versions expire."""
    layers, spec = own_layers(t), replace(USER_DIMENSION, expire_missing=True)
    silver = layers.silver_table("DimUser")
    for stamp, users in ((FIRST_RUN, t.users()), (RUN_TS, t.earlier_users())):
        publish_table(users, silver)
        runs.run_scd2(t.spark, layers, [spec], datetime.fromisoformat(stamp))
    return t.spark.table(layers.gold_table(spec.dimension)).select(
        "user_id", "subscription_type", "start_date", "end_date", "is_current"
    )


# Gold views


@registered
def dim_user_history(t: Tables) -> DataFrame:
    return VIEWS.build("gold_dim_user", t.silver, t.gold)


@registered
def dim_artist_history(t: Tables) -> DataFrame:
    return VIEWS.build("gold_dim_artist", t.silver, t.gold)


@registered
def dim_track_flag(t: Tables) -> DataFrame:
    return VIEWS.build("gold_dim_track", t.silver, t.gold)


@registered
def dim_date_calendar(t: Tables) -> DataFrame:
    return VIEWS.build("gold_dim_date", lambda _: t.dates("orders", "o_orderdate"), t.gold)


@registered
def track_keys(t: Tables) -> DataFrame:
    return listening.track_keys(t.tracks())


@registered
def date_keys(t: Tables) -> DataFrame:
    return listening.date_keys(t.dates("orders", "o_orderdate"))


@registered
def fact_resolved(t: Tables) -> DataFrame:
    return VIEWS.build("gold_fact_stream", t.silver, t.gold)


@registered
def fact_required(t: Tables) -> DataFrame:
    """The fact with its expectations enforced in the query itself."""
    return require(t.silver("FactStream"), listening.FACT_EXPECTATIONS)


@registered
def fact_expectations(t: Tables) -> DataFrame:
    """Violation counts on streams cut by two seconds, some of which are not positive then."""
    shortened = t.silver("FactStream").withColumn(
        "listen_duration", F.nullif(F.col("listen_duration") - 2, F.lit(5.0))
    )
    return violations(
        shortened,
        [*listening.FACT_EXPECTATIONS, Expectation("track_id_small", "track_id < 50")],
    )


@registered
def declared_join(t: Tables) -> DataFrame:
    return join_chain(t.silver, listening.STREAM_DETAIL_JOIN)


@registered
def declared_range_join(t: Tables) -> DataFrame:
    within = "f.track_id = t.track_id AND f.listen_duration < t.duration_sec"
    return join_chain(t.silver, [
        JoinSpec("FactStream", "f", ("f.stream_id", "f.listen_duration")),
        JoinSpec("DimTrack", "t", ("t.track_name", "t.duration_sec"), within),
    ])


@registered
def declared_or_join(t: Tables) -> DataFrame:
    """Equal keys named apart from a condition with alternatives."""
    either = "f.listen_duration > t.duration_sec OR f.device_type = 'or' OR t.album_name LIKE '%1'"
    return join_chain(t.silver, [
        JoinSpec("FactStream", "f", ("f.stream_id", "f.device_type")),
        JoinSpec("DimTrack", "t", ("t.track_id", "t.album_name"), either, on=(("f.track_id", "t.track_id"),)),
    ])


@registered
def full_run_fact(t: Tables) -> DataFrame:
    """The published fact after a full run: extract, ingest, check, version, publish."""
    layers = own_layers(t)
    source = f"{layers.root}/source"
    specs = listening.TABLES
    for spec in specs:
        rows = t.silver(spec.name)
        if spec.name == "FactStream":
            rows = rows.drop("event_date")
        rows.write.parquet(f"{source}/{spec.name}")
    runs.run_all(
        t.spark,
        layers,
        specs,
        ParquetSource(source),
        listening.DIMENSIONS,
        VIEWS,
        FOREIGN_KEYS,
        datetime.fromisoformat(RUN_TS),
    )
    return t.spark.table(layers.gold_table("gold_fact_stream"))


@registered
def fact_refreshed(t: Tables) -> DataFrame:
    """The fact after a refresh that follows changed users and artists and newly come streams."""
    layers = own_layers(t)
    ledger = Ledger(t.spark, layers.metadata_table(control.OPERATIONS))
    for name in ("DimTrack", "DimDate"):
        publish_table(t.silver(name), layers.silver_table(name))
    streams = stored(t.silver("FactStream"), "streams")
    early = ~F.col("device_type").eqNullSafe("view")
    for stamp, users, artists, arrived in (
        (FIRST_RUN, t.earlier_users(), t.earlier_artists(), streams.filter(early)),
        (RUN_TS, t.users(), t.artists(), streams.filter(~early)),
    ):
        publish_table(users, layers.silver_table("DimUser"))
        publish_table(artists, layers.silver_table("DimArtist"))
        runs.run_scd2(t.spark, layers, listening.DIMENSIONS, datetime.fromisoformat(stamp))
        upsert_table(arrived, layers.silver_table("FactStream"), ["stream_id"], ["event_date"], ledger=ledger)
        VIEWS.refresh(t.spark, layers, ["gold_fact_stream"])
    return t.spark.table(layers.gold_table("gold_fact_stream"))


# Quality checks and logs


def _checked(t: Tables) -> dict[str, DataFrame]:
    """Tables with faults: users in debt are unknown, error streams have no user."""
    paying = t("customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("user_id"))
    streams = t.streams().withColumn(
        "user_id", F.when(F.col("device_type") != "error", F.col("user_id"))
    )
    # Larger scales have parts beyond the hundred that streams refer to.
    tracks = t.tracks().filter("artist_id > 5")
    return {"FactStream": streams, "DimUser": paying, "DimTrack": tracks}


CHECKED_KEYS = {
    "FactStream": ("stream_id", "user_id"),
    "DimUser": ("user_id",),
    "DimTrack": ("track_id",),
}


def _previous(t: Tables) -> DataFrame:
    """Earlier sizes: streams by two thirds, a missing one for users, none for tracks."""
    return t.streams().agg(
        F.count_if(F.col("device_type").isin("view", "click")).alias("streams"),
        F.count_if(F.col("user_id").isNull()).alias("none"),
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("FactStream").alias("table_name"), F.col("streams").alias("rows")),
                F.struct(F.lit("DimUser").alias("table_name"), F.col("none").alias("rows")),
            )
        )
    )


@registered
def pk_null_checks(t: Tables) -> DataFrame:
    return quality.pk_null_checks(quality.profiles(_checked(t), CHECKED_KEYS))


@registered
def row_drift(t: Tables) -> DataFrame:
    measured = quality.profiles(_checked(t), CHECKED_KEYS)
    return quality.row_drift_checks(quality.with_previous_counts(measured, _previous(t), "rows"))


@registered
def fk_checks(t: Tables) -> DataFrame:
    return quality.foreign_key_checks(_checked(t).__getitem__, FOREIGN_KEYS)


@registered
def fk_orphans(t: Tables) -> DataFrame:
    tables = _checked(t)
    key = FOREIGN_KEYS[0]
    return quality.orphans(tables[key.child], tables[key.parent], key)


@registered
def quality_log(t: Tables) -> DataFrame:
    return quality.run_checks(
        _checked(t).__getitem__, CHECKED_KEYS, FOREIGN_KEYS, _previous(t), "rows"
    )


@registered
def quality_run(t: Tables) -> DataFrame:
    """What a run over silver tables logs before it fails on the faults."""
    layers = own_layers(t)
    specs = [TableSpec(name, keys[0], keys, keys[0]) for name, keys in CHECKED_KEYS.items()]
    control.bootstrap(t.spark, layers, specs)
    for name, df in _checked(t).items():
        publish_table(df, layers.silver_table(name))
    sizes = {row["table_name"]: row["rows"] for row in _previous(t).collect()}
    control.record_table_sizes(t.spark, layers, sizes)
    try:
        runs.run_quality(t.spark, layers, specs, FOREIGN_KEYS)
        raise AssertionError("the faults were not noticed")
    except runs.QualityError:
        log = t.spark.table(layers.metadata_table(control.QUALITY_LOG))
    return log.drop("check_timestamp")


@registered
def quality_incremental(t: Tables) -> DataFrame:
    """The checks from profiles kept by partition: a first load, then the rest of each table."""
    layers = own_layers(t)
    ledger = Ledger(t.spark, layers.metadata_table(control.OPERATIONS))
    control.bootstrap(t.spark, layers, [])
    tables = _checked(t)
    names = {name: layers.silver_table(name) for name in tables}
    layouts = {"FactStream": ("date_key",), "DimUser": (), "DimTrack": ()}
    first = {
        "FactStream": F.col("device_type") != "error", "DimUser": F.col("user_id") < 50, "DimTrack": F.col("track_id") < 50
    }
    for later in (False, True):
        for name, df in tables.items():
            some = F.coalesce(first[name], F.lit(False))
            batch = df.filter(~some if later else some).persist()
            upsert_table(batch, names[name], CHECKED_KEYS[name][:1], layouts[name], buckets=0 if layouts[name] else 4, ledger=ledger)
            batch.unpersist()
        measured = current_profiles(t.spark, layers, names, CHECKED_KEYS)
    return quality.run_checks(
        lambda name: read_state(t.spark, names[name]), CHECKED_KEYS, FOREIGN_KEYS, _previous(t), "rows", measured
    )


@registered
def run_log_listing(t: Tables) -> DataFrame:
    return newest_first(t.run_log(), "event_timestamp")


@registered
def run_log_recent(t: Tables) -> DataFrame:
    """The twenty newest log entries."""
    return recent_runs(t.run_log(), 20)


@registered
def failed_run_windows(t: Tables) -> DataFrame:
    return failure_windows(t.run_log(), threshold=1)


@registered
def failed_run_windows_stream(t: Tables) -> DataFrame:
    """The same over a streamed log: windows the watermark has closed."""
    root = fresh_dir(t.spark, "windows")
    t.run_log().write.parquet(f"{root}/log")
    schema = t.spark.read.parquet(f"{root}/log").schema
    stream = failure_windows(
        t.spark.readStream.schema(schema).parquet(f"{root}/log"), watermark="10 minutes"
    )
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{root}/windows")
        .option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(f"{root}/windows")


@registered
def failure_alerts_stream(t: Tables) -> DataFrame:
    """Windows of a log streamed in pieces that pass the threshold, each alerted once."""
    root = fresh_dir(t.spark, "alerts")
    t.run_log().repartition(4, "batch_id").write.parquet(f"{root}/log")
    schema = t.spark.read.parquet(f"{root}/log").schema
    log = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/log")
    query = (
        failure_alerts(log, threshold=1, keep="36500 days")
        .writeStream.format("parquet")
        .option("path", f"{root}/alerts")
        .option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return t.spark.read.schema(ALERT_DDL).parquet(f"{root}/alerts")
