"""Readers over the catalog and inline rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from siltstone.sinks.publish import quoted_table


def inline_rows(spark: SparkSession, rows: Iterable[Sequence[object]], ddl: str) -> DataFrame:
    """A small relation written down in code, typed by a DDL string.

    The rows become literals of the plan, as in ``VALUES``, so reading them starts no
    Python worker.
    """
    kind = StructType([StructField(f.name, f.dataType) for f in StructType.fromDDL(ddl).fields])
    literals = [F.struct(*[F.lit(value) for value in row]) for row in rows]
    listed = F.array(*literals) if literals else F.lit(None)
    return spark.range(0, 1, 1, 1).select(F.inline(listed.cast(ArrayType(kind))))


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {quoted_table(schema)}")


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows for a person to look at."""
    return df.limit(rows)


def temp_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
