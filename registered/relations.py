"""The warehouse's source tables, derived from the given parquet tables.

``SQL`` states each relation for the oracle; the functions state it for Spark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.scd2 import dimension_schema, scd2_apply
from siltstone.plans.control import WATERMARK_DDL
from siltstone.plans.listening import ARTIST_DIMENSION, USER_DIMENSION
from siltstone.session import stored
from siltstone.specs import Scd2Spec, TableSpec

FIRST_RUN = "2026-03-01 00:00:00"
RUN_TS = "2026-03-31 06:57:00"
LINE_KEYS = ("l_orderkey", "l_linenumber")
LINE_TIES = ("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus")
LINES = TableSpec(
    "lineitem", "l_shipdate", LINE_KEYS, "l_shipdate", schema_name="shop", tie_breakers=LINE_TIES
)
ORDERS = TableSpec("orders", "o_orderdate", ("o_orderkey",), "o_orderdate", schema_name="shop")
EVENTS = TableSpec("events", "ts", ("event_id",), "ts", schema_name="shop")


class Tables:
    """The given tables, and the relations derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def users(self) -> DataFrame:
        nation = self("nation").select("n_nationkey", "n_name")
        joined = self("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        return joined.select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("user_name"),
            F.col("n_name").alias("country"),
            F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("subscription_type"),
            F.lit("2020-01-01").cast("date").alias("start_date"),
            F.lit(None).cast("date").alias("end_date"),
            _stamp("c_nationkey").alias("updated_at"),
        )

    def earlier_users(self) -> DataFrame:
        """What was known at the first run: accounts in credit, the rich ones on trial."""
        balances = self("customer").select(F.col("c_custkey").alias("user_id"), "c_acctbal")
        return (
            self.users()
            .join(balances, "user_id")
            .filter("c_acctbal >= 0")
            .withColumn(
                "subscription_type",
                F.when(F.col("c_acctbal") > 7500, F.lit("TRIAL")).otherwise(
                    F.col("subscription_type")
                ),
            )
            .drop("c_acctbal")
        )

    def artists(self) -> DataFrame:
        return (
            self("supplier")
            .join(self("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("s_suppkey").alias("artist_id"),
                F.col("s_name").alias("artist_name"),
                F.col("r_name").alias("genre"),
                F.col("n_name").alias("country"),
                _stamp("s_nationkey").alias("updated_at"),
            )
        )

    def earlier_artists(self) -> DataFrame:
        balances = self("supplier").select(F.col("s_suppkey").alias("artist_id"), "s_acctbal")
        return (
            self.artists()
            .join(balances, "artist_id")
            .filter("s_acctbal >= 1000")
            .withColumn(
                "genre",
                F.when(F.col("s_acctbal") > 5000, F.lit("UNKNOWN")).otherwise(F.col("genre")),
            )
            .drop("s_acctbal")
        )

    def tracks(self) -> DataFrame:
        return self("part").select(
            F.col("p_partkey").alias("track_id"),
            F.concat_ws("-", "p_name", "p_brand", "p_type").alias("track_name"),
            F.col("p_size").cast("bigint").alias("artist_id"),
            F.col("p_brand").alias("album_name"),
            (F.col("p_size") * 10).alias("duration_sec"),
            F.date_add(F.lit("2015-01-01").cast("date"), F.col("p_size")).alias("release_date"),
            _stamp("p_size").alias("updated_at"),
        )

    def dates(self, table: str = "events", column: str = "ts") -> DataFrame:
        date = F.col("date")
        return self(table).select(F.to_date(column).alias("date")).distinct().select(
            F.date_format(date, "yyyyMMdd").cast("int").alias("date_key"),
            "date",
            F.day(date).alias("day"),
            F.month(date).alias("month"),
            F.year(date).alias("year"),
            F.date_format(date, "EEEE").alias("weekday"),
        )

    def streams(self) -> DataFrame:
        return self("events").select(
            F.col("event_id").alias("stream_id"),
            "user_id",
            F.get_json_object("props", "$.k").cast("bigint").alias("track_id"),
            F.date_format("ts", "yyyyMMdd").cast("int").alias("date_key"),
            (F.col("value") + 1).alias("listen_duration"),
            F.col("event_type").alias("device_type"),
            F.col("ts").alias("stream_timestamp"),
        )

    def silver(self, name: str) -> DataFrame:
        """The tables as the gold views read them."""
        if name == "FactStream":
            return self.streams().withColumn("event_date", F.to_date("stream_timestamp"))
        relations: dict[str, Callable[[], DataFrame]] = {
            "DimUser": self.users,
            "DimArtist": self.artists,
            "DimTrack": self.tracks,
            "DimDate": self.dates,
        }
        return relations[name]()

    def first_dimension(self, spec: Scd2Spec) -> DataFrame:
        """The dimension after its first run, kept as a table would be."""
        source = self.earlier_users() if spec is USER_DIMENSION else self.earlier_artists()
        empty = self.spark.createDataFrame([], dimension_schema(source.schema, spec)).limit(0)
        return stored(scd2_apply(empty, source, spec, FIRST_RUN), "dimension")

    def dimension(self, spec: Scd2Spec) -> DataFrame:
        """The dimension after its second run."""
        source = self.users() if spec is USER_DIMENSION else self.artists()
        return scd2_apply(self.first_dimension(spec), source, spec, RUN_TS)

    def gold(self, name: str) -> DataFrame:
        specs = {s.dimension: s for s in (USER_DIMENSION, ARTIST_DIMENSION)}
        return self.dimension(specs[name])

    def configs(self) -> DataFrame:
        """A feed per customer, to load that customer's orders."""
        return self("customer").select(
            F.col("c_mktsegment").alias("schema_name"),
            F.col("c_name").alias("table_name"),
            F.lit("o_orderdate").alias("cdc_column"),
            (F.col("c_acctbal") >= 0).alias("is_active"),
            "c_acctbal",
        )

    def loads(self, status: str) -> DataFrame:
        """Per customer feed, what a load amounts to: F the stored orders, O all others."""
        names = self("customer").select("c_custkey", F.col("c_name").alias("table_name"))
        return (
            self("orders")
            .filter(F.when(F.col("o_orderstatus") == "F", "F").otherwise("O") == status)
            .groupBy("o_custkey")
            .agg(
                F.max("o_orderdate").cast("timestamp").alias("newest"),
                F.count(F.lit(1)).alias("orders"),
                F.max("o_totalprice").alias("largest"),
            )
            .join(names, F.col("o_custkey") == F.col("c_custkey"))
        )

    def watermarks(self) -> DataFrame:
        stored = self.loads("F").select(
            "table_name",
            F.col("newest").alias("last_load_timestamp"),
            F.col("orders").alias("last_row_count"),
            F.lit("SUCCESS").alias("load_status"),
            F.lit(FIRST_RUN).cast("timestamp").alias("last_updated_at"),
            F.lit(None).cast("bigint").alias("table_row_count"),
        )
        assert stored.columns == [c.split()[0] for c in WATERMARK_DDL.split(", ")]
        return stored

    def lines(self, status: str) -> DataFrame:
        return self("lineitem").filter(F.col("l_linestatus") == status)

    def run_log(self) -> DataFrame:
        """Events as pipeline runs; error events are the failed ones."""
        return self("events").select(
            F.col("ts").alias("event_timestamp"),
            F.lit("silver_ingestion").alias("notebook_name"),
            F.col("event_type").alias("table_name"),
            F.col("user_id").alias("rows_read"),
            F.col("user_id").alias("rows_written"),
            F.col("value").alias("duration_seconds"),
            F.when(F.col("event_type") == "error", F.lit("FAILED"))
            .otherwise(F.lit("SUCCESS"))
            .alias("status"),
            F.lit(None).cast("string").alias("error_message"),
            F.col("event_id").cast("string").alias("batch_id"),
            F.lit("interactive").alias("run_id"),
        )


def _stamp(days: str):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col(days))
    return day.cast("timestamp_ntz")


def _dimension_sql(name: str, current: str, earlier: str, columns: list[str], hashed: str,
                   key: str, surrogate: str) -> str:
    cols = ", ".join(f"s.{c}" for c in columns)

    def version(stamp: str) -> str:
        return (
            f"CAST('{stamp}' AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date, "
            f"true AS is_current, {hashed} AS attribute_hash, "
            f"TIMESTAMP '{stamp}' AS record_start_ts, CAST(NULL AS TIMESTAMP) AS record_end_ts, "
            f"sha256(CAST(s.{key} AS VARCHAR) || '||{stamp}') AS {surrogate}"
        )

    return f"""
{name}_first AS (SELECT {cols}, {version(FIRST_RUN)} FROM {earlier} s),
{name}_changes AS (
  SELECT {cols}, {version(RUN_TS)} FROM {current} s
  LEFT JOIN {name}_first t ON s.{key} = t.{key}
  WHERE t.{key} IS NULL OR t.attribute_hash <> {hashed}),
{name}_second AS (
  SELECT t.* REPLACE (
    CASE WHEN c.{key} IS NULL THEN t.end_date ELSE CAST('{RUN_TS}' AS DATE) END AS end_date,
    c.{key} IS NULL AS is_current,
    CASE WHEN c.{key} IS NULL THEN t.record_end_ts ELSE TIMESTAMP '{RUN_TS}' END AS record_end_ts)
  FROM {name}_first t LEFT JOIN {name}_changes c ON t.{key} = c.{key}
  UNION ALL BY NAME SELECT * FROM {name}_changes)"""


SQL = f"""
users AS (
  SELECT c_custkey AS user_id, c_name AS user_name, n_name AS country,
         nullif(c_mktsegment, 'MACHINERY') AS subscription_type, DATE '2020-01-01' AS source_start_date,
         CAST(NULL AS DATE) AS source_end_date,
         CAST(DATE '2024-01-01' + c_nationkey AS TIMESTAMP) AS source_updated_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
earlier_users AS (
  SELECT users.* REPLACE (CASE WHEN c_acctbal > 7500 THEN 'TRIAL' ELSE subscription_type END AS subscription_type)
  FROM users JOIN customer ON user_id = c_custkey WHERE c_acctbal >= 0),
artists AS (
  SELECT s_suppkey AS artist_id, s_name AS artist_name, r_name AS genre, n_name AS country,
         CAST(DATE '2024-01-01' + s_nationkey AS TIMESTAMP) AS source_updated_at
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
earlier_artists AS (
  SELECT artists.* REPLACE (CASE WHEN s_acctbal > 5000 THEN 'UNKNOWN' ELSE genre END AS genre)
  FROM artists JOIN supplier ON artist_id = s_suppkey WHERE s_acctbal >= 1000),
tracks AS (
  SELECT p_partkey AS track_id, concat_ws('-', p_name, p_brand, p_type) AS track_name,
         CAST(p_size AS BIGINT) AS artist_id, p_brand AS album_name, p_size * 10 AS duration_sec,
         CAST(DATE '2015-01-01' + p_size AS DATE) AS release_date,
         CAST(DATE '2024-01-01' + p_size AS TIMESTAMP) AS updated_at
  FROM part),
streams AS (
  SELECT event_id AS stream_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS track_id,
         CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, value + 1 AS listen_duration,
         event_type AS device_type, ts AS stream_timestamp, CAST(ts AS DATE) AS event_date
  FROM events),
loads AS (
  SELECT c_name AS table_name, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'O' END AS status, max(o_orderdate) AS newest,
         count(*) AS orders, max(o_totalprice) AS largest
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
watermarks AS (
  SELECT table_name, newest AS last_load_timestamp, orders AS last_row_count,
         'SUCCESS' AS load_status, TIMESTAMP '{FIRST_RUN}' AS last_updated_at,
         CAST(NULL AS BIGINT) AS table_row_count
  FROM loads WHERE status = 'F'),
latest_lines AS (
  SELECT * FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, {', '.join(c + ' DESC' for c in LINE_TIES)}) = 1),
status_lines AS (
  SELECT * FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_linestatus, l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, {', '.join(c + ' DESC' for c in LINE_TIES)}) = 1),
stored_lines AS (SELECT * FROM status_lines WHERE l_linestatus = 'F'),
incoming_lines AS (SELECT * FROM status_lines WHERE l_linestatus = 'O'),
merged_lines AS (
  SELECT * FROM stored_lines s WHERE NOT EXISTS (
    SELECT 1 FROM incoming_lines i
    WHERE i.l_orderkey = s.l_orderkey AND i.l_linenumber = s.l_linenumber)
  UNION ALL SELECT * FROM incoming_lines),
{_dimension_sql("dim_user", "users", "earlier_users",
   ["user_id", "user_name", "country", "subscription_type", "source_start_date", "source_end_date", "source_updated_at"],
   "sha256(concat_ws('||', s.user_name, s.country, s.subscription_type))", "user_id", "surrogate_user_key")},
{_dimension_sql("dim_artist", "artists", "earlier_artists",
   ["artist_id", "artist_name", "genre", "country", "source_updated_at"],
   "sha256(concat_ws('||', s.artist_name, s.genre, s.country))", "artist_id", "surrogate_artist_key")}
"""


def with_relations(select: str) -> str:
    return f"WITH {SQL.strip()}\n{select.strip()}"
