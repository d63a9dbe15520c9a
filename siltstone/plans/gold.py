"""Gold layer: named view functions, published in the order they were declared.

A view that follows a table is refreshed by what changed: partitions of that table which the operation
ledger names since the last refresh, and partitions with rows whose lookups resolve to other
values now. Only those are computed, checked and replaced; the others keep their files.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.expectations import Expectation, ExpectationError, violation_columns
from siltstone.operators.joins import Lookup
from siltstone.plans.control import OPERATIONS, VIEW_STATE, VIEW_STATE_DDL
from siltstone.session import stored
from siltstone.sinks.ledger import Ledger
from siltstone.sinks.publish import (
    PartitionKey,
    Published,
    append_table,
    layout_of,
    new_snapshot_path,
    partition_filter,
    partition_keys,
    publish_table,
    swap_partitions,
    table_partitions,
    write_snapshot,
)
from siltstone.sinks.upsert import read_state
from siltstone.sources.tables import inline_rows
from siltstone.specs import Layers, quoted

LATER = "_later"
Reader = Callable[[str], DataFrame]
Lookups = Callable[[Reader, Reader], dict[str, Lookup]]


def no_lookups(silver: Reader, gold: Reader) -> dict[str, Lookup]:
    return {}


@dataclass(frozen=True)
class Followed:
    """The table a view follows, by layer and name, and the frames its rows are resolved with."""

    layer: str
    table: str
    lookups: Lookups = no_lookups


@dataclass(frozen=True)
class View:
    """A published result: ``build`` gets readers of silver and gold tables by name, or, of a
    view that follows a table, rows of that table and the lookups by name."""

    name: str
    build: Callable[..., DataFrame]
    expectations: tuple[Expectation, ...] = ()
    partition_by: tuple[str, ...] = ()
    follows: Followed | None = None

    def whole(self, silver: Reader, gold: Reader) -> DataFrame:
        if not self.follows:
            return self.build(silver, gold)
        read = silver if self.follows.layer == "silver" else gold
        return self.build(read(self.follows.table), self.follows.lookups(silver, gold))


class Views:
    """Registry of views.

    >>> views = Views()
    >>> @views.add("daily", expectations=[Expectation("has_day", "day IS NOT NULL")])
    ... def daily(silver, gold): return silver("FactStream").select("day")
    """

    def __init__(self) -> None:
        self.declared: dict[str, View] = {}

    def add(
        self,
        name: str,
        expectations: Sequence[Expectation] = (),
        partition_by: Sequence[str] = (),
    ) -> Callable[[Callable[[Reader, Reader], DataFrame]], Callable[[Reader, Reader], DataFrame]]:
        """A view that is computed whole at every refresh."""

        def register(build):
            self.declared[name] = View(name, build, tuple(expectations), tuple(partition_by))
            return build

        return register

    def follow(
        self,
        name: str,
        table: str,
        layer: str = "silver",
        partition_by: Sequence[str] = (),
        lookups: Lookups = no_lookups,
        expectations: Sequence[Expectation] = (),
    ) -> Callable[[Callable[[DataFrame, dict[str, Lookup]], DataFrame]], Callable]:
        """A view over the rows of ``table``, partitioned as that table is, refreshed by what changed.

        The function gets rows of the table, all or those of some partitions, and the lookups.
        Each row of the view must come from one row of the table, in the same partition, and
        depend on other tables by the lookups alone.
        """
        if not partition_by:
            raise ValueError(f"{name}: a view that follows a table needs partitions")

        def register(build):
            followed = Followed(layer, table, lookups)
            self.declared[name] = View(name, build, tuple(expectations), tuple(partition_by), followed)
            return build

        return register

    def build(self, name: str, silver: Reader, gold: Reader) -> DataFrame:
        return self.declared[name].whole(silver, gold)

    def refresh(
        self, spark: SparkSession, layers: Layers, names: Collection[str] | None = None
    ) -> dict[str, Published]:
        """Bring every view, or those named, up to date; a broken expectation stops the refresh.

        What a view that follows a table reports is what was written, so nothing if nothing changed.
        """

        def silver(table: str) -> DataFrame:
            return read_state(spark, layers.silver_table(table))

        def gold(table: str) -> DataFrame:
            return spark.table(layers.gold_table(table))

        return {
            view.name: _refreshed(spark, layers, view, silver, gold)
            for view in self.declared.values()
            if names is None or view.name in names
        }


def _refreshed(spark: SparkSession, layers: Layers, view: View, silver: Reader, gold: Reader) -> Published:
    table, ledger = layers.gold_table(view.name), Ledger(spark, layers.metadata_table(OPERATIONS))
    if not view.follows:
        return publish_table(view.whole(silver, gold), table, view.partition_by, view.expectations, ledger=ledger)

    followed = view.follows
    source = layers.silver_table(followed.table) if followed.layer == "silver" else layers.gold_table(followed.table)
    seen = _seen(spark, layers, view) if spark.catalog.tableExists(table) else None
    # The version is read before the rows: what comes in between is looked at again next time.
    version = ledger.version(source)
    rows = (silver if followed.layer == "silver" else gold)(followed.table)
    lookups = {
        name: replace(lookup, frame=stored(lookup.frame.select(*map(quoted, (*lookup.keys, *lookup.values))), "lookup"))
        for name, lookup in followed.lookups(silver, gold).items()
    }
    touched = None if seen is None else ledger.touched(source, seen, view.partition_by)
    if touched is None:
        done = publish_table(view.build(rows, lookups), table, view.partition_by, view.expectations, ledger=ledger)
    else:
        affected = _resolved_anew(spark, layers, view, source, rows, lookups, touched)
        if not affected and version == seen:
            return Published("", 0)
        done = _replace_partitions(view, table, rows, lookups, affected, ledger) if affected else Published("", 0)
    for name, lookup in lookups.items():
        publish_table(lookup.frame, _lookup_table(layers, view, name))
    append_table(inline_rows(spark, [(view.name, version)], VIEW_STATE_DDL), layers.metadata_table(VIEW_STATE))
    return done


def _seen(spark: SparkSession, layers: Layers, view: View) -> int | None:
    """Version of the followed table at the last refresh."""
    state = spark.table(layers.metadata_table(VIEW_STATE)).filter(F.col("view_name") == view.name)
    return state.agg(F.max("version")).first()[0]


def _lookup_table(layers: Layers, view: View, name: str) -> str:
    """Where the lookup frame of the last refresh is kept."""
    return layers.gold_table(f"{view.name}__{name}")


def changed_keys(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that resolve to other values than before, or to some where there were none, or the reverse."""
    sides = before.withColumn(LATER, F.lit(False)).unionByName(after.withColumn(LATER, F.lit(True)))
    once = sides.groupBy(*map(quoted, before.columns)).agg((F.min(LATER) == F.max(LATER)).alias(LATER)).filter(LATER)
    return once.select(*map(quoted, keys)).distinct()


def _resolved_anew(
    spark: SparkSession, layers: Layers, view: View, source: str, rows: DataFrame, lookups: dict[str, Lookup],
    touched: set[PartitionKey],
) -> set[PartitionKey]:
    """``touched``, and partitions of the followed table with rows whose lookups changed since the last refresh.

    Only partitions that are not among them yet are looked at, and nothing once none is left.
    """
    same = [c.lower() for c in layout_of(spark, source)] == [c.lower() for c in view.partition_by]
    existing = table_partitions(spark, source) if same else None
    affected = set(touched)
    for name, lookup in lookups.items():
        if existing is not None and existing <= affected:
            break
        before = spark.table(_lookup_table(layers, view, name))
        changed = stored(changed_keys(before, lookup.frame, lookup.keys), "changed")
        if not changed.isEmpty():
            here = F.coalesce(partition_filter(rows.schema, view.partition_by, affected), F.lit(False))
            hit = rows.filter(~here).select(*map(quoted, dict.fromkeys([*lookup.keys, *view.partition_by])))
            affected |= partition_keys(hit.join(changed, list(lookup.keys), "left_semi"), view.partition_by)
    return affected


def _replace_partitions(
    view: View,
    table: str,
    rows: DataFrame,
    lookups: dict[str, Lookup],
    affected: set[PartitionKey],
    ledger: Ledger,
) -> Published:
    """Compute, check and swap in the affected partitions."""
    spark, checks = rows.sparkSession, violation_columns(view.expectations)
    some = rows.filter(partition_filter(rows.schema, view.partition_by, affected))
    done = write_snapshot(
        view.build(some, lookups), new_snapshot_path(spark, table), view.partition_by, checks
    )
    broken = {name: int(done.metrics[name]) for name in checks if done.metrics.get(name)}
    if broken:
        raise ExpectationError(table, broken)
    operation = ledger.start(table, "REFRESH", view.partition_by, affected)
    swap_partitions(spark, table, view.partition_by, done.location, affected)
    spark.catalog.refreshTable(table)
    ledger.finish(operation, done.location, done.rows, done.rows, 0, done.rows)
    return done
