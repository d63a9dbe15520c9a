"""The music-listening warehouse: its tables, rules, dimensions, checks and gold views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.derive import bucket, calendar_columns
from siltstone.functions.hashing import hash_key
from siltstone.operators.expectations import Expectation
from siltstone.operators.joins import Lookup, resolve_keys
from siltstone.plans.gold import Reader, Views
from siltstone.specs import ColumnRule, ForeignKey, JoinSpec, Scd2Spec, TableSpec

# Source columns of each table.
SOURCE_DDL = {
    "DimUser": (
        "user_id INT, user_name STRING, country STRING, subscription_type STRING, "
        "start_date DATE, end_date DATE, updated_at TIMESTAMP"
    ),
    "DimArtist": (
        "artist_id INT, artist_name STRING, genre STRING, country STRING, updated_at TIMESTAMP"
    ),
    "DimTrack": (
        "track_id INT, track_name STRING, artist_id INT, album_name STRING, duration_sec INT, "
        "release_date DATE, updated_at TIMESTAMP"
    ),
    "DimDate": "date_key INT, date DATE, day INT, month INT, year INT, weekday STRING",
    "FactStream": (
        "stream_id BIGINT, user_id INT, track_id INT, date_key INT, listen_duration INT, "
        "device_type STRING, stream_timestamp TIMESTAMP"
    ),
}

# What conforming does to each table.
RULES = {
    "DimUser": (ColumnRule("user_name", F.upper),),
    "DimTrack": (ColumnRule("track_name", lambda c: F.regexp_replace(c, "-", " ")),),
    "FactStream": (ColumnRule("stream_timestamp", F.to_date, "event_date"),),
}

TABLES = (
    TableSpec("DimUser", "updated_at", ("user_id",), "updated_at", rules=RULES["DimUser"]),
    TableSpec("DimArtist", "updated_at", ("artist_id",), "updated_at"),
    TableSpec("DimTrack", "updated_at", ("track_id",), "updated_at", rules=RULES["DimTrack"]),
    TableSpec("DimDate", "date", ("date_key",), "date", partition_by=("year", "month")),
    TableSpec(
        "FactStream",
        "stream_timestamp",
        ("stream_id",),
        "stream_timestamp",
        partition_by=("event_date",),
        rules=RULES["FactStream"],
    ),
)

# The checks the warehouse runs by default; two more keys are declared at the source.
FOREIGN_KEYS = (
    ForeignKey("FactStream", "user_id", "DimUser"),
    ForeignKey("FactStream", "track_id", "DimTrack"),
)
MORE_FOREIGN_KEYS = (
    ForeignKey("FactStream", "date_key", "DimDate"),
    ForeignKey("DimTrack", "artist_id", "DimArtist"),
)

USER_DIMENSION = Scd2Spec(
    dimension="dim_user_scd2",
    source="DimUser",
    keys=("user_id",),
    tracked=("user_name", "country", "subscription_type"),
    surrogate="surrogate_user_key",
    carried={
        "start_date": "source_start_date",
        "end_date": "source_end_date",
        "updated_at": "source_updated_at",
    },
)
ARTIST_DIMENSION = Scd2Spec(
    dimension="dim_artist_scd2",
    source="DimArtist",
    keys=("artist_id",),
    tracked=("artist_name", "genre", "country"),
    surrogate="surrogate_artist_key",
    carried={"updated_at": "source_updated_at"},
)
DIMENSIONS = (USER_DIMENSION, ARTIST_DIMENSION)

# Upper bounds of the duration labels, in seconds.
DURATION_BOUNDS = ((150, "low"), (300, "medium"))
DURATION_ABOVE = "high"

# Columns of the fact, and what must hold of it.
FACT_COLUMNS = (
    "stream_id",
    "user_id",
    "track_id",
    "artist_id",
    "date_key",
    "listen_duration",
    "device_type",
    "stream_timestamp",
    "event_date",
    "user_key",
    "artist_key",
    "track_key",
    "date_dim_key",
)
FACT_EXPECTATIONS = (
    Expectation("user_id_not_null", "user_id IS NOT NULL"),
    Expectation("listen_duration_positive", "listen_duration > 0"),
)

# The default declared join.
STREAM_DETAIL_JOIN = (
    JoinSpec("FactStream", "factstream", ("factstream.stream_id", "factstream.listen_duration")),
    JoinSpec(
        "DimUser",
        "dimuser",
        ("dimuser.user_id", "dimuser.user_name"),
        "factstream.user_id = dimuser.user_id",
    ),
    JoinSpec(
        "DimTrack",
        "dimtrack",
        ("dimtrack.track_id", "dimtrack.track_name"),
        "factstream.track_id = dimtrack.track_id",
    ),
)

VIEWS = Views()


def track_keys(tracks: DataFrame) -> DataFrame:
    """``track_id, artist_id, track_key`` of every track."""
    return tracks.select(
        "track_id", "artist_id", hash_key("track_id", "updated_at").alias("track_key")
    )


def date_keys(dates: DataFrame) -> DataFrame:
    return dates.select("date_key", hash_key("date_key").alias("date_dim_key"))


def current_keys(dimension: DataFrame, key: str, surrogate: str, alias: str) -> DataFrame:
    """Business key and surrogate of the current versions, which are in the open partition."""
    current = dimension.filter(F.col("is_current") & F.col("end_date").isNull())
    return current.select(key, F.col(surrogate).alias(alias))


@VIEWS.follow("gold_dim_user", USER_DIMENSION.dimension, "gold", partition_by=("end_date",))
def gold_dim_user(versions: DataFrame, lookups: dict[str, Lookup]) -> DataFrame:
    """Every version of every user."""
    return versions


@VIEWS.follow("gold_dim_artist", ARTIST_DIMENSION.dimension, "gold", partition_by=("end_date",))
def gold_dim_artist(versions: DataFrame, lookups: dict[str, Lookup]) -> DataFrame:
    """Every version of every artist."""
    return versions


@VIEWS.add("gold_dim_track")
def gold_dim_track(silver: Reader, gold: Reader) -> DataFrame:
    flag = bucket(F.col("duration_sec"), DURATION_BOUNDS, DURATION_ABOVE)
    return silver("DimTrack").withColumn("durationFlag", flag)


@VIEWS.follow("gold_dim_date", "DimDate", partition_by=("year", "month"))
def gold_dim_date(dates: DataFrame, lookups: dict[str, Lookup]) -> DataFrame:
    return dates.withColumns(calendar_columns(F.col("date")))


def fact_lookups(silver: Reader, gold: Reader) -> dict[str, Lookup]:
    """The keys that streams are resolved with.

    Artists are resolved on the track side, which is far smaller than the fact: the
    fact then takes one join for both track and artist, and is never shuffled by the
    artist, whose keys are the most skewed.
    """
    artists = current_keys(
        gold(ARTIST_DIMENSION.dimension), "artist_id", ARTIST_DIMENSION.surrogate, "artist_key"
    )
    tracks = resolve_keys(
        track_keys(silver("DimTrack")), [Lookup(artists, ("artist_id",), ("artist_key",))]
    )
    users = current_keys(
        gold(USER_DIMENSION.dimension), "user_id", USER_DIMENSION.surrogate, "user_key"
    )
    return {
        "dates": Lookup(date_keys(silver("DimDate")), ("date_key",), ("date_dim_key",)),
        "tracks": Lookup(tracks, ("track_id",), ("artist_id", "track_key", "artist_key")),
        "users": Lookup(users, ("user_id",), ("user_key",)),
    }


@VIEWS.follow(
    "gold_fact_stream", "FactStream", partition_by=("event_date",), lookups=fact_lookups,
    expectations=FACT_EXPECTATIONS,
)
def gold_fact_stream(streams: DataFrame, lookups: dict[str, Lookup]) -> DataFrame:
    """Streams with the surrogate keys of the current user, artist, track and date."""
    return resolve_keys(streams, list(lookups.values())).select(*FACT_COLUMNS)
