"""Stream of landed file paths: each file is handed out once per checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Schema of Spark's binaryFile source; only the path is ever selected, so the content
# of the files is not read here.
FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
MAX_FILES_PER_BATCH = 10_000
# Spark passes over files much older than the newest one it has seen. A century takes all.
MAX_FILE_AGE = "36500d"


def landed_paths(
    spark: SparkSession, folder: str, max_files: int = MAX_FILES_PER_BATCH
) -> DataFrame:
    """Streaming frame with one ``path`` per parquet file below ``folder``.

    Streaming paths instead of rows lets each batch check the files' own schemas before
    a row is read; a typed parquet stream would drop new columns silently. ``max_files``
    bounds what one batch hands to the driver. A file counts however old its modification
    time is, so the stream remembers every path it has seen.
    """
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", MAX_FILE_AGE)
        .load(folder)
        .select("path")
    )


def batch_paths(batch: DataFrame) -> list[str]:
    """The file paths of one micro-batch, at most ``max_files`` strings."""
    return sorted(row["path"] for row in batch.select("path").collect())
