"""Declarations that drive the library: tables, keys, versioned dimensions, joins."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, SparkSession


def quoted(name: str) -> str:
    """A column name safe to hand to ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class ColumnRule:
    """Derive ``target`` (default: the column itself) from ``column`` when it exists."""

    column: str
    derive: Callable[[Column], Column]
    target: str | None = None


@dataclass(frozen=True)
class TableSpec:
    """One table on its way from the source to the silver layer."""

    name: str
    cdc_column: str
    primary_keys: tuple[str, ...]
    order_column: str
    schema_name: str = "dbo"
    bronze_path: str | None = None
    silver_table: str | None = None
    target_path: str | None = None
    partition_by: tuple[str, ...] = ()
    tie_breakers: tuple[str, ...] = ()
    rules: tuple[ColumnRule, ...] = ()
    is_active: bool = True
    # True promises that a key never changes partition, so an upsert looks for
    # existing rows in the incoming partitions only instead of scanning all keys.
    stable_partitions: bool = False
    # Lays the table out by this many hash buckets of the key when it is first written, so an
    # upsert reads and rewrites only the buckets of its batch.
    key_buckets: int = 0
    # False keeps the stored row when an incoming one is older, so the outcome does not
    # depend on how landed files are cut into batches. With True it does: the row of the
    # last batch wins, whatever its order column says.
    last_batch_wins: bool = False
    # How a relational source is read: see ``JdbcSource``.
    split_column: str | None = None
    num_partitions: int | None = None
    single_task: bool = False

    def __post_init__(self) -> None:
        for label in ("name", "cdc_column", "order_column"):
            if not getattr(self, label):
                raise ValueError(f"table spec needs {label}")
        for label in ("primary_keys", "partition_by"):
            value = getattr(self, label)
            if isinstance(value, str):
                raise ValueError(f"{self.name}: {label} must be a list of columns")
            object.__setattr__(self, label, tuple(value))
        if self.key_buckets < 0 or self.key_buckets and not self.primary_keys:
            raise ValueError(f"{self.name}: key_buckets needs primary keys and is not negative")
        object.__setattr__(self, "bronze_path", self.bronze_path or self.name)
        object.__setattr__(self, "silver_table", self.silver_table or self.name)
        object.__setattr__(self, "target_path", self.target_path or self.name)

    def with_rules(self, *rules: ColumnRule) -> TableSpec:
        return replace(self, rules=tuple(rules))


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_column: str | None = None

    @property
    def target_column(self) -> str:
        return self.parent_column or self.column


@dataclass(frozen=True)
class Scd2Spec:
    """A dimension versioned by a hash over its tracked attributes.

    ``carried`` maps source columns to dimension columns for what is stored but not
    tracked, e.g. the source's own validity dates.
    """

    dimension: str
    source: str
    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    surrogate: str
    carried: Mapping[str, str] = field(default_factory=dict)
    null_token: str | None = None
    expire_missing: bool = False

    @property
    def columns(self) -> tuple[str, ...]:
        """Output order of the dimension."""
        return (
            self.surrogate,
            *self.keys,
            *self.tracked,
            *self.carried.values(),
            "start_date",
            "end_date",
            "is_current",
            "attribute_hash",
            "record_start_ts",
            "record_end_ts",
        )


@dataclass(frozen=True)
class JoinSpec:
    """One entry of a declared join; the first entry of a list is the base.

    ``on`` names what must be equal, as pairs of an earlier entry's expression and the entry's own; the
    ``condition`` may then be any further SQL. A range without equality needs ``span``: a value
    of earlier entries, the low and the high end of the entry's own range that holds it, and a
    bucket width to join on.
    """

    table: str
    alias: str
    cols: tuple[str, ...]
    condition: str | None = None
    span: tuple[str, str, str, float] | None = None
    on: tuple[tuple[str, str], ...] = ()

    @classmethod
    def of(cls, entry: Mapping[str, object]) -> JoinSpec:
        """Build from a plain mapping; ``cols`` is a list, or text naming bare columns."""
        cols = entry["cols"]
        if isinstance(cols, str):
            if "(" in cols or "'" in cols:
                raise ValueError(f"give expressions as a list: {cols!r}")
            cols = [part.strip() for part in cols.split(",")]
        return cls(
            table=str(entry["table"]),
            alias=str(entry["alias"]),
            cols=tuple(cols),
            condition=entry.get("condition"),
            span=tuple(entry["span"]) if entry.get("span") else None,
            on=tuple((earlier, own) for earlier, own in entry.get("on") or ()),
        )


@dataclass(frozen=True)
class Layers:
    """Where the layers live: catalog schemas, and a root folder for landed files."""

    root: str
    silver: str = "silver"
    gold: str = "gold"
    metadata: str = "metadata"
    catalog: str | None = None

    def _name(self, *parts: str) -> str:
        return ".".join(part for part in (self.catalog, *parts) if part)

    def schemas(self) -> tuple[str, str, str]:
        """Full names of the silver, gold and metadata schemas."""
        return tuple(self._name(s) for s in (self.silver, self.gold, self.metadata))

    def silver_table(self, table: str) -> str:
        return self._name(self.silver, table)

    def gold_table(self, table: str) -> str:
        return self._name(self.gold, table)

    def metadata_table(self, table: str) -> str:
        return self._name(self.metadata, table)

    def bronze(self, spec: TableSpec) -> str:
        return f"{self.root}/bronze/{spec.bronze_path}"

    def stream_state(self, spec: TableSpec, kind: str) -> str:
        """Checkpoint or schema folder of a table's ingest stream."""
        return f"{self.root}/silver_state/{spec.target_path}/{kind}"

    @classmethod
    def from_conf(cls, spark: SparkSession, root: str, defaults: Mapping[str, str]) -> Layers:
        """Names from the session configuration, falling back to ``defaults``."""

        def pick(key: str, fallback: str | None) -> str | None:
            return spark.conf.get(key, defaults.get(key, fallback))

        return cls(
            root=root,
            silver=pick("silver_schema", "silver"),
            gold=pick("gold_schema", "gold"),
            metadata=pick("metadata_schema", "metadata"),
            catalog=pick("catalog_name", None),
        )


def table_specs(
    entries: Iterable[Mapping[str, object]],
    rules: Mapping[str, Sequence[ColumnRule]] | None = None,
) -> list[TableSpec]:
    """Specs from configuration entries, with column rules added by table name."""
    specs = []
    for entry in entries:
        name = str(entry.get("table_name", ""))
        specs.append(
            TableSpec(
                name=name,
                cdc_column=entry.get("cdc_column", ""),
                primary_keys=entry.get("primary_keys", ()),
                order_column=entry.get("deduplicate_order_column") or entry.get("cdc_column", ""),
                schema_name=entry.get("source_schema", "dbo"),
                bronze_path=entry.get("bronze_path"),
                silver_table=entry.get("silver_table"),
                target_path=entry.get("target_path"),
                partition_by=entry.get("partition_by") or (),
                is_active=bool(entry.get("is_active", True)),
                key_buckets=int(entry.get("key_buckets") or 0),
                split_column=entry.get("split_column"),
                num_partitions=entry.get("num_partitions"),
                single_task=bool(entry.get("single_task", False)),
                rules=tuple((rules or {}).get(name, ())),
            )
        )
    names = [spec.name for spec in specs]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"tables declared twice: {repeated}")
    return specs


def load_table_specs(
    path: str, rules: Mapping[str, Sequence[ColumnRule]] | None = None
) -> list[TableSpec]:
    """Read ``{"tables": [...]}`` from a JSON file."""
    with open(path, encoding="utf-8") as handle:
        return table_specs(json.load(handle)["tables"], rules)
