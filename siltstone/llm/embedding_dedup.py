"""Near-duplicate vectors of equal label by tiled comparison in PCA order.

All vectors are rotated onto the principal axes of the whole table, so the leading coordinates
carry most of a dot product. Vectors are laid in tiles along the first axis within their label.
Tile pairs whose bounding boxes are too far apart are left out; in the others products grow
block by block of coordinates, and a pair is dropped as soon as its partial product plus the
product of the remaining norms cannot reach the threshold. What is left is confirmed on the
original coordinates in double precision. A tile pair gives link counts and a spanning forest, never its pairs.
Exact copies are compared once and counted as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import components, spread
from siltstone.session import stored

TILE = 1024
BLOCK = 8
BOX = 4
SLACK = 1e-9


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their coordinates as packed doubles, null unless all are finite and one is not zero."""
    for batch in batches:
        packed = []
        for value in batch.column("embedding").to_pylist():
            x = None
            if value and None not in value:
                x = np.array(value, np.float64)
                largest = np.abs(x).max()
                if not np.isfinite(largest) or largest == 0:
                    x = None
                elif not 1e-100 < largest < 1e100:
                    # Squares of such numbers leave the range of doubles; only the direction counts.
                    x = x / largest
            packed.append(None if x is None else x.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(packed, pa.binary())],
            names=["vec_id", "label", "packed"],
        )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed outer products of the unit vectors of a partition, by number of coordinates."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        dims = np.asarray(batch.column("dim"))
        for dim in np.unique(dims):
            u = _units(_matrix(batch.column("packed").filter(pa.array(dims == dim))))
            sums[dim] = sums.get(dim, 0) + u.T @ u
    yield from _sum_rows(sums)


def _sum_rows(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    keys = sorted(sums)
    yield pa.RecordBatch.from_arrays(
        [pa.array([int(k) for k in keys], pa.int32()), pa.array([sums[k].tobytes() for k in keys], pa.binary())],
        names=["dim", "sums"],
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for dim, data in zip(batch.column("dim").to_pylist(), batch.column("sums").to_pylist(), strict=True):
            sums[dim] = sums.get(dim, 0) + np.frombuffer(data).reshape(dim, dim)
    yield from _sum_rows(sums)


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Axes (columns, leading first) of all vectors (dim, packed), fitted on every row.

    The driver receives at most sixteen matrices per number of coordinates.
    """
    kind = "dim int, sums binary"
    some = vectors.select("dim", "packed").mapInArrow(_moments, kind).repartition(16).mapInArrow(_added, kind)
    sums: dict[int, list[np.ndarray]] = {}
    for row in some.collect():
        sums.setdefault(row["dim"], []).append(np.frombuffer(bytes(row["sums"])).reshape(row["dim"], row["dim"]))
    return {dim: np.linalg.eigh(reduce(np.add, m))[1][:, ::-1].copy() for dim, m in sums.items()}


def _leading(axes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            lead = np.zeros(len(dims))
            for dim in np.unique(dims):
                own = dims == dim
                lead[own] = _units(_matrix(batch.column("packed").filter(pa.array(own)))) @ axes.value[int(dim)][:, 0]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lead)], names=[*batch.schema.names, "lead"]
            )

    return run


TILES = (
    "tile long, label {label}, dim int, lo array<double>, hi array<double>, ids binary, copies binary, packed binary"
)


def _tiles(axes, size: int):
    """Runs of up to ``size`` vectors of one label, in order of the first axis, with their bounding box."""

    def tile(table: pa.Table, number: int) -> pa.RecordBatch:
        dim = table.column("dim")[0].as_py()
        x = _matrix(table.column("packed").combine_chunks())
        box = _units(x) @ axes.value[dim][:, :BOX]
        box = np.pad(box, ((0, 0), (0, BOX - box.shape[1])))
        pack = lambda c: table.column(c).to_numpy().astype(np.int64).tobytes()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([(TaskContext.get().partitionId() << 32) + number]),
                table.column("label").combine_chunks().slice(0, 1), pa.array([dim], pa.int32()),
                pa.array([box.min(0).tolist()]), pa.array([box.max(0).tolist()]),
                pa.array([pack("rep")], pa.binary()), pa.array([pack("copies")], pa.binary()),
                pa.array([x.tobytes()], pa.binary()),
            ],
            names=["tile", "label", "dim", "lo", "hi", "ids", "copies", "packed"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, number, rows = [], None, 0, 0
        for batch in batches:
            keys = list(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True))
            at = 0
            while at < len(keys):
                if held and (keys[at] != key or rows == size):
                    yield tile(pa.Table.from_batches(held), number)
                    held, rows, number = [], 0, number + 1
                key, end = keys[at], at
                while end < len(keys) and keys[end] == key and rows + end - at < size:
                    end += 1
                held.append(batch.slice(at, end - at))
                rows += end - at
                at = end
        if held:
            yield tile(pa.Table.from_batches(held), number)

    return run


def linked_pairs(x, y, u, v, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine of at least ``least``; ``u`` and ``v`` are the rotated unit vectors of ``x`` and ``y``."""
    width = u.shape[1]
    tail = lambda w: np.sqrt(np.maximum(0, np.cumsum((w * w)[:, ::-1], axis=1)[:, ::-1]))
    tu, tv = tail(u), tail(v)
    after = min(BLOCK, width)
    part = u[:, :after] @ v[:, :after].T
    bound = part + (np.outer(tu[:, after], tv[:, after]) if after < width else 0)
    bound = np.triu(bound >= least - SLACK, 1) if same else bound >= least - SLACK
    i, j = np.nonzero(bound)
    part = part[i, j]
    while after < width and len(i):
        nxt = min(after + BLOCK, width)
        part = part + np.einsum("ij,ij->i", u[i, after:nxt], v[j, after:nxt])
        rest = tu[i, nxt] * tv[j, nxt] if nxt < width else 0
        keep = part + rest >= least - SLACK
        i, j, part, after = i[keep], j[keep], part[keep], nxt
    size = lambda w: np.sqrt(np.einsum("ij,ij->i", w, w))
    keep = np.zeros(len(i), bool)
    for k in range(0, len(i), 1 << 14):
        a, b = x[i[k : k + (1 << 14)]], y[j[k : k + (1 << 14)]]
        keep[k : k + (1 << 14)] = np.einsum("ij,ij->i", a, b) / (size(a) * size(b)) >= least
    return i[keep], j[keep]


def forest(i: np.ndarray, j: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` nodes the smallest node reachable over the pairs."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[i], root[j])
        nxt = root.copy()
        np.minimum.at(nxt, i, low)
        np.minimum.at(nxt, j, low)
        np.minimum.at(nxt, root[i], low)
        np.minimum.at(nxt, root[j], low)
        nxt = nxt[nxt]
        if np.array_equal(nxt, root):
            return root
        root = nxt


def _compared(axes, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                same = row["tile"] == row["tile_b"]
                ids, copies = (np.frombuffer(row[c], np.int64) for c in ("ids", "copies"))
                x = np.frombuffer(row["packed"]).reshape(len(ids), -1)
                u = _units(x) @ axes.value[row["dim"]]
                y, v, ids_b, copies_b = x, u, ids, copies
                if not same:
                    ids_b, copies_b = (np.frombuffer(row[c], np.int64) for c in ("ids_b", "copies_b"))
                    y = np.frombuffer(row["packed_b"]).reshape(len(ids_b), -1)
                    v = _units(y) @ axes.value[row["dim"]]
                i, j = linked_pairs(x, y, u, v, least, same)
                if not len(i):
                    continue
                j = j if same else j + len(ids)
                nodes = ids if same else np.concatenate([ids, ids_b])
                times = copies if same else np.concatenate([copies, copies_b])
                links = np.bincount(i, times[j], len(nodes)) + np.bincount(j, times[i], len(nodes))
                root = nodes[forest(i, j, len(nodes))]
                on = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[on]), pa.array(links[on].astype(np.int64)), pa.array(root[on])],
                    names=["rep", "links", "root"],
                )

    return run


def similar_vectors(vectors: DataFrame, least: float = 0.93, tile: int = TILE) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    ``vectors`` needs ``vec_id``, ``embedding`` and ``label``; further columns are ignored. Rows are compared if their
    labels are equal and not null and they have equally many coordinates. A null, empty or zero vector, one with a
    null or non-finite coordinate, and a row without ``vec_id`` links with nothing and is kept. Repeated rows count
    as vectors of their own for ``n_links``. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    label = vectors.schema["label"].dataType.simpleString()
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding")
    ).mapInArrow(_valid, f"vec_id long, label {label}, packed binary")
    able = F.col("packed").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    marked = stored(rows.withColumn("packed", F.when(able, F.col("packed"))), "vectors")
    usable = marked.where("packed is not null").withColumn("dim", (F.length("packed") / 8).cast("int"))
    axes = spark.sparkContext.broadcast(principal_axes(usable))
    distinct = usable.groupBy("label", "dim", "packed").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    laid = (
        distinct.mapInArrow(_leading(axes), f"label {label}, dim int, packed binary, rep long, copies long, lead double")
        .repartitionByRange(spread(spark), "label", "dim", "lead", "rep")
        .sortWithinPartitions("label", "dim", "lead", "rep")
    )
    tiles = stored(laid.mapInArrow(_tiles(axes, tile), TILES.format(label=label)), "tiles")
    box = tiles.select("tile", "label", "dim", "lo", "hi")
    other = box.select(F.col("tile").alias("tile_b"), "label", "dim", F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"))
    gap = lambda k: F.greatest(F.lit(0.0), F.col("lo_b")[k] - F.col("hi")[k], F.col("lo")[k] - F.col("hi_b")[k])
    apart = reduce(lambda a, b: a + b, (gap(k) * gap(k) for k in range(BOX)))
    pairs = (
        box.join(other, ["label", "dim"]).where("tile <= tile_b").where(apart <= 2 - 2 * least + SLACK)
        .select("tile", "tile_b")
    )
    right = tiles.select(
        F.col("tile").alias("tile_b"), F.col("ids").alias("ids_b"), F.col("copies").alias("copies_b"),
        F.col("packed").alias("packed_b"),
    )
    full = pairs.join(tiles.select("tile", "dim", "ids", "copies", "packed"), "tile").join(right, "tile_b")
    found = stored(full.mapInArrow(_compared(axes, least), "rep long, links long, root long"), "tile_links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    placed = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    groups = (
        distinct.select("label", "packed", "rep", "copies").join(links, "rep", "left")
        .join(placed.withColumnRenamed("node", "rep"), "rep", "left")
        .select("label", "packed", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    component = F.coalesce("component_id", "vec_id")
    return marked.join(groups, ["label", "packed"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
