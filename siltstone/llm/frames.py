"""Helpers the operators share: tables, document keys, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.session import stored, tune

LAST = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, least: int = 1) -> int:
    """Number of shuffle partitions of the session, at least ``least``."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def sheltered(docs: DataFrame, names: set[str]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns that are named like one of ``names`` under free names, and those names by the old ones."""
    used, moved = {c.lower() for c in docs.columns} | names, {}
    for column in docs.columns:
        if column.lower() in names:
            free = f"{column}_own"
            while free.lower() in used:
                free += "_"
            used.add(free.lower())
            moved[column] = free
    return docs.withColumnsRenamed(moved), moved


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, component) with the smallest node of each.

    Random-order contraction: each node hooks onto the neighbour of least hashed rank if that
    is below its own, edges move to the hooks, and inner edges vanish. About half of the nodes
    go in each round, so rounds grow with the logarithm of the nodes. Each round is written to the
    shared folder; a node with very many neighbours is reduced by partial aggregation and
    joined by skew-aware joins.
    """
    spark = edges.sparkSession
    a, b = F.col("a"), F.col("b")
    live = stored(edges.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "edges")
    placed, turn = None, 0
    while not live.isEmpty():
        seed = F.lit(turn)
        rank = lambda c: F.struct(F.xxhash64(c, seed).alias("r"), c.alias("n"))
        both = live.select("a", "b").unionByName(live.select(b.alias("a"), a.alias("b")))
        hooks = both.groupBy("a").agg(F.min(rank(b)).alias("best"))
        hooks = stored(
            hooks.select(
                a.alias("node"),
                F.when(F.col("best") < rank(a), F.col("best.n")).otherwise(a).alias("root"),
            ),
            "hooks",
        )
        if placed is None:
            placed = hooks
        else:
            nxt = hooks.select(F.col("node").alias("root"), F.col("root").alias("up"))
            placed = stored(
                placed.join(nxt, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "placed"
            )
        left = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = live.join(left, "a").join(right, "b").where("ra <> rb")
        live = stored(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        turn += 1
    if placed is None:
        return live.select(a.alias("node"), b.alias("component"))
    least = placed.groupBy("root").agg(F.min("node").alias("component"))
    return placed.join(least, "root").select("node", "component")
