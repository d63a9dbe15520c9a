"""Merkle manifest of a dataset: a tree per group, a tree over the groups, and a proof for every row.

A row's leaf is the SHA-256 of its fields. Leaves of a group ascend by key, and every ``FAN`` consecutive nodes
become one until a single node, the group's subroot, is left; the subroots, ordered by group, become the root in
the same way. Trees are built by grouping blocks of ``FAN ** LEVELS`` consecutive nodes, which gives ``LEVELS`` levels
per shuffle.

Proofs come by pointer jumping. Every node holds the siblings of its step towards the root (a segment) and points
to its parent. Joining the nodes to themselves by that pointer doubles the distance it spans and appends the
segment found there, so a leaf reaches the root after a logarithmic number of joins in the height. A join keeps only
nodes that later ones start from: each second level of the group trees, then each fourth, and so on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.frames import spread
from siltstone.session import stored

FAN, LEVELS = 3, 4
TALLEST = 39  # FAN ** TALLEST is the last power that a long holds
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*values: Column) -> Column:
    """SHA-256 of the values one after the other, each as its size in UTF-8 bytes, ``:`` and its text, null as ``-``."""
    texts = [v.cast("string") for v in values]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*sized), 256)


def _text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def fold(leaf: Column, segments: Column) -> Column:
    """The root that a leaf (hex text) leads to with the siblings of a proof."""
    step = lambda h, s: F.sha2(F.concat(_text(s["left"]), h, _text(s["right"])), 256)
    return F.aggregate(segments, leaf, step)


def proof_digest(segments: Column) -> Column:
    """SHA-256 of all siblings of a proof, level by level, left to right."""
    siblings = F.transform(segments, lambda s: _text(F.concat(s["left"], s["right"])))
    return F.sha2(F.array_join(siblings, ""), 256)


def _numbered(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows in ranges by group and order, and for each (group, part) how its row ids become places in the group.

    Ranges cut through a hot group. A row's place is ``at - shift``; the second frame has one row per
    range and group in it, with the number of rows of the group.
    """
    sort = [F.col(c).asc_nulls_first() for c in (group, *order)]
    dealt = rows.repartitionByRange(spread(rows.sparkSession), *sort).sortWithinPartitions(*sort)
    dealt = stored(dealt.withColumn("at", F.monotonically_increasing_id()), "ranges")
    dealt = dealt.withColumn("part", F.shiftright("at", 33))
    held = dealt.groupBy(group, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    one = Window.partitionBy(group)
    before = F.sum("n").over(one.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shift = F.col("first") - F.coalesce(before, F.lit(0))
    return dealt, held.select(group, "part", shift.alias("shift"), F.sum("n").over(one).alias("size"))


def _placed(dealt: DataFrame, held: DataFrame, group: str) -> DataFrame:
    """``dealt`` with each row's place ``idx`` and what ``held`` says of its group."""
    known = held.withColumnsRenamed({group: "same", "part": "same_part"})
    on = dealt[group].eqNullSafe(known["same"]) & (dealt["part"] == known["same_part"])
    joined = dealt.join(known, on).withColumn("idx", F.col("at") - F.col("shift"))
    return joined.drop("same", "same_part", "at", "part", "shift")


def _height(size: Column) -> Column:
    powers = F.expr(f"array({', '.join(f'{FAN**k}L' for k in range(TALLEST + 1))})")
    return F.size(F.filter(powers, lambda p: p < size))


def _grown(leaves: DataFrame, tallest: int) -> DataFrame:
    """All nodes over ``leaves`` (tree, idx, size, digest, row): these with ``level``, ``height``, ``left`` and ``right``.

    ``left`` and ``right`` are the digests before and after a node in its run; ``row`` is kept on leaves.
    """
    base, made = leaves.withColumn("height", _height(F.col("size"))), []
    for level in range(0, tallest + 1, LEVELS):
        run = F.sort_array(F.collect_list(F.struct("idx", "digest", "row")))
        runs = base.groupBy("tree", "height", F.expr(f"idx div {FAN**LEVELS}").alias("block")).agg(run.alias("run"))
        runs = runs.withColumn("v0", F.expr("transform(run, x -> lower(hex(x.digest)))"))
        for t in range(LEVELS):
            above = f"transform(sequence(1, size(v{t}), {FAN}), i -> sha2(array_join(slice(v{t}, i, {FAN}), ''), 256))"
            more = f"{level + t} < height AND size(v{t}) > 0"
            runs = runs.withColumn(f"v{t + 1}", F.expr(f"CASE WHEN {more} THEN {above} ELSE CAST(array() AS array<string>) END"))
        nodes = []
        for t in range(LEVELS + 1):
            # The siblings of a block's highest node lie in other blocks.
            left, right = (
                f"unhex(array_join(slice(v{t}, {start}, {count}), ''))" if t < LEVELS else "CAST(NULL AS binary)"
                for start, count in ((f"i - i % {FAN} + 1", f"i % {FAN}"), ("i + 2", f"{FAN - 1} - i % {FAN}"))
            )
            nodes.append(
                f"transform(v{t}, (x, i) -> struct({level + t} AS level, block * {FAN ** (LEVELS - t)} + i AS idx, "
                f"unhex(x) AS digest, {left} AS `left`, {right} AS `right`, "
                f"CASE WHEN {level + t} = 0 THEN run[i].row END AS row))"
            )
        found = stored(runs.selectExpr("tree", "height", f"inline(concat({', '.join(nodes)}))"), "levels")
        made.append(found.where("`left` IS NOT NULL"))
        base = found.where("`left` IS NULL").drop("left", "right", "level")
    return reduce(DataFrame.unionByName, made)


def proofs(rows: DataFrame, group: str, key: str, leaf: str) -> DataFrame:
    """Adds ``subroot``, ``root`` and ``segments`` to every row: the digests and the siblings from its leaf to the root.

    ``leaf`` is a column of hex digests. Leaves of a group ascend by ``key``, null first, equal keys by leaf; groups ascend
    bytewise, null first. Rows that are equal in both get neighbouring places, in any order. Digests are hex text;
    ``segments`` is an array of (left, right) with the siblings' bytes, from the leaf's level upwards. All columns of
    ``rows`` are returned, with ``subroot``, ``root`` and ``segments`` replaced if there. An empty table gives no rows.
    """
    kept = [c for c in rows.columns if c not in ("subroot", "root", "segments")]
    flat = rows.select(
        F.col(group).alias("grp"), F.col(key).alias("key"), F.col(leaf).alias("leaf"), F.struct(*kept).alias("row")
    )
    flat = stored(flat, "leaves").withColumn("tie", F.monotonically_increasing_id())
    dealt, held = _numbered(flat, "grp", ("key", "leaf", "tie"))
    held = stored(held, "held")
    groups = held.select("grp", "size", F.lit(0).alias("all")).distinct()
    ordered, places = _numbered(groups.withColumnRenamed("size", "rows"), "all", ("grp",))
    trees = stored(_placed(ordered, places, "all").withColumnRenamed("idx", "tree"), "trees")
    biggest, count = trees.agg(F.max("rows"), F.count(F.lit(1))).first()
    named = trees.select(F.col("grp").alias("same_grp"), "tree")
    held = held.join(named, held["grp"].eqNullSafe(named["same_grp"])).drop("same_grp")
    leaves = _placed(dealt, held, "grp").select("tree", "idx", "size", F.unhex("leaf").alias("digest"), "row")

    def tall(size: int | None) -> int:
        return sum(FAN**k < (size or 0) for k in range(TALLEST + 1))

    nodes = _grown(leaves, tall(biggest))
    tops = nodes.where("level = height").select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(count).cast("long").alias("size"), "digest",
        F.lit(None).cast(leaves.schema["row"].dataType).alias("row"),
    )
    return _jumped(nodes, _grown(tops, tall(count)))


def _jumped(nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """Rows of the leaves in ``nodes`` with their way to the root of ``tops``."""
    own = "array(struct(`left`, `right`))"
    below = nodes.where("level < height OR height = 0").selectExpr(
        "tree", "level", "idx", "row",
        f"CASE WHEN height = 0 THEN slice({own}, 1, 0) ELSE {own} END AS segments",  # a lone leaf is the subroot itself
        f"CASE WHEN level + 1 >= height THEN CAST({TOP} AS bigint) ELSE tree END AS up_tree",
        "CASE WHEN level + 1 >= height THEN 0 ELSE level + 1 END AS up_level",
        f"CASE WHEN level + 1 >= height THEN tree ELSE idx div {FAN} END AS up_idx",
        "CAST(NULL AS binary) AS subroot", "CAST(NULL AS binary) AS root",
    )
    above = tops.selectExpr(
        "tree", "level", "idx", "row",
        f"CASE WHEN level = height THEN slice({own}, 1, 0) ELSE {own} END AS segments",
        "CASE WHEN level < height THEN tree END AS up_tree",
        "CASE WHEN level < height THEN level + 1 END AS up_level",
        f"CASE WHEN level < height THEN idx div {FAN} END AS up_idx",
        "CASE WHEN level = 0 THEN digest END AS subroot", "CASE WHEN level = height THEN digest END AS root",
    )
    live, done, span = below.unionByName(above), [], 1
    while True:
        starts = live.where(f"up_tree IS NOT NULL AND (tree = {TOP} OR level % {2 * span} = 0)").alias("a")
        ends = live.where(f"tree = {TOP} OR level % {2 * span} = {span}").selectExpr(
            "tree AS at_tree", "level AS at_level", "idx AS at_idx", "segments AS more", "up_tree AS then_tree",
            "up_level AS then_level", "up_idx AS then_idx", "subroot AS their_subroot", "root AS their_root",
        )
        on = F.expr("up_tree = at_tree AND up_level = at_level AND up_idx = at_idx")
        moved = starts.join(ends, on).selectExpr(
            "tree", "level", "idx", "row", "concat(segments, more) AS segments", "then_tree AS up_tree",
            "then_level AS up_level", "then_idx AS up_idx", "coalesce(subroot, their_subroot) AS subroot",
            "coalesce(root, their_root) AS root",
        )
        # Inner nodes that have reached the root already are still what others jump to.
        ready = live.where(f"up_tree IS NULL AND (tree = {TOP} OR level % {2 * span} = 0)")
        live = stored(moved.unionByName(ready), "jumps")
        leaf = f"tree <> {TOP} AND level = 0"
        done.append(live.where(f"{leaf} AND up_tree IS NULL"))
        live = live.where(f"NOT ({leaf} AND up_tree IS NULL)")
        if live.where(leaf).isEmpty():
            break
        span *= 2
    found = reduce(DataFrame.unionByName, done)
    return found.selectExpr("row.*", "lower(hex(subroot)) AS subroot", "lower(hex(root)) AS root", "segments")


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", key: str = "doc_id") -> DataFrame:
    """Per row of ``docs`` its ``key`` and ``group``, and ``leaf``, ``subroot``, ``root`` and ``segments`` of its proof.

    Nulls in any field count as a value of their own; a null group is a group, before all others. Empty and very long texts
    are hashed where they are read. Further columns of ``docs`` are left out.
    """
    return proofs(docs.select(key, group, digest(*[docs[f] for f in fields]).alias("leaf")), group, key, "leaf")


def verified(rows: DataFrame, presented: str) -> DataFrame:
    """Adds ``folded_root``, recomputed from the leaf in ``presented`` and the row's proof, and ``verified``."""
    folded = rows.withColumn("folded_root", fold(F.col(presented), F.col("segments")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
