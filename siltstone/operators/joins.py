"""Left joins that widen a base: key lookups for facts, and declared join chains."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.specs import JoinSpec, quoted


@dataclass(frozen=True)
class Lookup:
    """Columns ``values`` found by equal ``keys``; the frame must be unique per key."""

    frame: DataFrame
    keys: tuple[str, ...]
    values: tuple[str, ...]


def resolve_keys(base: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Left-join each lookup; unresolved keys leave NULLs and no row is lost.

    The base is always the left side, which keeps AQE free to split the partition of
    a hot key and to broadcast a lookup whose measured size allows it.
    """
    for lookup in lookups:
        frame = lookup.frame.select(*[quoted(c) for c in (*lookup.keys, *lookup.values)])
        base = base.join(frame, list(lookup.keys), "left")
    return base


BUCKET = "_bucket"


def _bucketed(right: DataFrame, spec: JoinSpec) -> tuple[DataFrame, Column]:
    """The entry once per bucket its range touches, and the equality that finds the value's bucket."""
    value, low, high, width = spec.span
    bucket = lambda text: F.floor(F.expr(text) / F.lit(width))
    each = right.withColumn(BUCKET, F.explode(F.sequence(bucket(low), bucket(high))))
    return each.alias(spec.alias), bucket(value) == F.col(f"{quoted(spec.alias)}.{BUCKET}")


def join_chain(read: Callable[[str], DataFrame], specs: Sequence[JoinSpec]) -> DataFrame:
    """Base table, then one left join per further entry.

    An entry joins on the equal pairs it names (``on``), within the range of its ``span``, and on its
    ``condition``, all AND-ed; the condition is SQL text over the aliases that Spark alone
    reads. A condition may also stand by itself: Spark joins by the equalities it finds in it, and
    compares every pair of rows if there are none. The result holds every entry's columns in
    order. Names must not repeat.
    """
    if not specs:
        raise ValueError("a declared join needs a base table")
    base, *others = specs
    joined = read(base.table).alias(base.alias)
    for spec in others:
        right, terms = read(spec.table).alias(spec.alias), []
        if spec.span:
            right, bucketed = _bucketed(right, spec)
            terms.append(bucketed)
        terms += [F.expr(earlier) == F.expr(own) for earlier, own in spec.on]
        if spec.condition:
            terms.append(F.expr(spec.condition))
        elif not spec.on:
            raise ValueError(f"join with {spec.alias} has no condition")
        joined = joined.join(right, reduce(Column.__and__, terms), "left")
    result = joined.selectExpr(*[col for spec in specs for col in spec.cols])
    repeated = sorted({c for c in result.columns if result.columns.count(c) > 1})
    if repeated:
        raise ValueError(f"give aliases to repeated columns: {repeated}")
    return result
