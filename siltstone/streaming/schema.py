"""Pinned schema of an ingest stream: guard against new columns, rescue of bad values."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegralType,
    StringType,
    StructType,
)

from siltstone.functions.derive import RESCUED
from siltstone.operators.keyed import sortable
from siltstone.sources.tables import inline_rows
from siltstone.specs import quoted

MERGE_CONFLICT = "CANNOT_MERGE_SCHEMAS"
WIDEST_DECIMAL = "decimal(38,18)"


class NewColumnsError(ValueError):
    """A landed file has columns the pinned schema does not know."""

    def __init__(self, columns: Sequence[str]) -> None:
        self.columns = list(columns)
        super().__init__(f"new columns in landed files: {', '.join(self.columns)}")


def file_schemas(spark: SparkSession, paths: Sequence[str]) -> list[tuple[StructType, list[str]]]:
    """Paths grouped into sets with one mergeable schema.

    Footers are merged by Spark in a distributed job. Only when types conflict is each
    landing folder, which one run writes in one schema, merged by itself: at most a job per
    folder, however types alternate. A folder that conflicts inside is halved.
    """
    try:
        return [(spark.read.option("mergeSchema", "true").parquet(*paths).schema, list(paths))]
    except (PySparkException, Py4JJavaError) as error:
        if len(paths) == 1 or MERGE_CONFLICT not in str(error):
            raise
    parts: dict[str, list[str]] = {}
    for path in paths:
        parts.setdefault(path.rsplit("/", 1)[0], []).append(path)
    middle = len(paths) // 2
    split = list(parts.values()) if len(parts) > 1 else [paths[:middle], paths[middle:]]
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for some in split:
        for schema, members in file_schemas(spark, some):
            groups.setdefault(schema.json(), (schema, []))[1].extend(members)
    return list(groups.values())


def pinned_schema(spark: SparkSession, location: str, paths: Sequence[str]) -> StructType:
    """The schema stored at ``location``; the first call infers it from ``paths``."""
    try:
        stored = spark.read.text(location, wholetext=True).first()
    except AnalysisException:
        stored = None
    if stored is not None:
        return StructType.fromJson(json.loads(stored["value"]))
    schema = file_schemas(spark, paths)[0][0]
    inline_rows(spark, [(schema.json(),)], "value STRING").write.mode("overwrite").text(location)
    return schema


def guard_schema(pinned: StructType, found: StructType) -> None:
    """Fail when a file brings columns that are not pinned."""
    known = {name.lower() for name in pinned.names}
    unknown = [name for name in found.names if name.lower() not in known]
    if unknown:
        raise NewColumnsError(unknown)


def conforms(pinned: StructType, found: StructType) -> bool:
    """Whether every column present has its pinned type."""
    kinds = {f.name.lower(): f.dataType.simpleString() for f in found.fields}
    return all(
        kinds.get(f.name.lower(), f.dataType.simpleString()) == f.dataType.simpleString()
        for f in pinned.fields
    )


def _fits(value: Column, fitted: Column, source: DataType, target: DataType) -> Column:
    """Whether a cast that succeeded kept the value.

    Text is compared with its parse into the widest type of the target's family, so "7"
    and "07" both fit an INT, while a text with a time of day does not fit a DATE. Other
    values must come back unchanged from the target type. Maps cannot be compared.
    """
    if isinstance(source, StringType):
        if isinstance(target, (IntegralType, DecimalType)):
            wide = value.try_cast(WIDEST_DECIMAL)
            return wide.isNull() | wide.eqNullSafe(fitted.try_cast(WIDEST_DECIMAL))
        if isinstance(target, DateType):
            stamp = value.try_cast("timestamp")
            return stamp.isNull() | stamp.eqNullSafe(fitted.cast("timestamp"))
        return F.lit(True)
    return fitted.try_cast(source).eqNullSafe(value) if sortable(source) else F.lit(True)


def rescue(df: DataFrame, pinned: StructType) -> DataFrame:
    """Cast to the pinned types; values that do not fit go to ``_rescued_data`` as JSON.

    A value fits if its cast succeeds and loses nothing. Absent columns become NULL. Rows
    without a bad value get a NULL rescue column.
    """
    present = {name.lower(): name for name in df.columns}
    columns, misfits = [], []
    for field in pinned.fields:
        name = present.get(field.name.lower())
        if name is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(quoted(name))
        if df.schema[name].dataType.simpleString() == field.dataType.simpleString():
            columns.append(value.alias(field.name))
            continue
        fitted = value.try_cast(field.dataType)
        kept = fitted.isNotNull() & _fits(value, fitted, df.schema[name].dataType, field.dataType)
        columns.append(F.when(kept, fitted).alias(field.name))
        misfits.append(F.when(~kept & value.isNotNull(), value).alias(field.name))
    if misfits:
        packed = F.to_json(F.struct(*misfits))
        columns.append(F.when(packed != "{}", packed).alias(RESCUED))
    else:
        columns.append(F.lit(None).cast("string").alias(RESCUED))
    return df.select(*columns)


def read_pinned(spark: SparkSession, paths: Sequence[str], pinned: StructType) -> DataFrame:
    """Rows of the given files in the pinned schema plus the rescue column.

    Files whose schema agrees are read in one scan; files with other types are read by
    their own schema and cast.
    """
    frames, plain = [], []
    for schema, members in file_schemas(spark, paths):
        guard_schema(pinned, schema)
        if conforms(pinned, schema):
            plain.extend(members)
        else:
            frames.append(rescue(spark.read.schema(schema).parquet(*members), pinned))
    if plain:
        frames.append(rescue(spark.read.schema(pinned).parquet(*plain), pinned))
    return reduce(DataFrame.unionByName, frames)
