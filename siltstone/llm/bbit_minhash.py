"""Near-duplicate documents by b-bit MinHash over word shingles.

Sets of hashed word shingles give 128 minima each. Bands of minima propose candidates, the low
bits of all minima, packed into a signature, estimate their similarity by counting equal
entries corrected for chance collisions, and full sets confirm every link.

Candidates of a bucket are not expanded into pairs. First each member is compared with the
bucket's smallest document. Only buckets whose members are then still in different components
are compared further, across components, in tiles of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import components, spread
from siltstone.llm.kernels import Rolling, lower_ascii, mix, ragged, slices, text_bytes, word_spans
from siltstone.session import stored

SLICE = 1 << 20
TILE = 512


@dataclass(frozen=True)
class Near:
    """``percent``: least similarity; ``bands`` of ``rows`` minima propose, ``bits`` of each are kept.

    At similarity 0.75, 32 bands of 4 rows miss a pair with probability 5e-6. ``deviations``
    standard deviations of the estimate are allowed before a candidate is dropped unconfirmed.
    """

    percent: int = 75
    width: int = 5
    bands: int = 32
    rows: int = 4
    bits: int = 4
    deviations: float = 5.0

    @property
    def least_equal(self) -> int:
        """Equal signature entries a linked pair has, but for ``deviations``."""
        size, chance = self.bands * self.rows, 2.0**-self.bits
        equal = chance + (1 - chance) * self.percent / 100
        return int(np.floor(size * equal - self.deviations * np.sqrt(size * equal * (1 - equal))))


def shingle_sets(data: np.ndarray, bounds: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """For each document its sorted distinct shingle hashes and a 128-bit hash of its word sequence."""
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, bounds)
    words = Rolling(data).spans(starts, ends)
    seeds = mix(np.arange(1, width + 1, dtype=np.uint64))
    runs = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        runs += words[k : len(words) - width + 1 + k] * (seeds[k] | np.uint64(1))
    runs = mix(runs)
    for a, b in zip(first[:-1], first[1:], strict=True):
        own = words[a:b]
        at = np.arange(len(own), dtype=np.uint64)
        one, two = int(mix(own + mix(at)).sum()), int(mix(own ^ mix(at + np.uint64(1 << 40))).sum())
        if len(own) >= width:
            hashes = np.unique(runs[a : b - width + 1])
        else:
            hashes = np.array([one], np.uint64)[: len(own)]
        yield hashes, one, two


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _signatures(near: Near):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = near.bands * near.rows
        draw = np.random.default_rng(20_011)
        factor = draw.integers(0, 1 << 31, (size, 1), np.uint32) * np.uint32(2) + np.uint32(1)
        offset = draw.integers(0, 1 << 32, (size, 1), np.uint32)
        salt = mix(np.arange(near.bands, dtype=np.uint64) + np.uint64(77))
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            ids, out = batch.column("doc_id"), []
            for i, j in slices(bounds, SLICE):
                part = shingle_sets(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], near.width)
                for hashes, one, two in part:
                    if not len(hashes):
                        out.append((0, None, None, None, None))
                        continue
                    short, low = (hashes >> np.uint64(32)).astype(np.uint32), None
                    for k in range(0, len(short), 2048):
                        drawn = short[None, k : k + 2048] * factor
                        drawn += offset
                        step = drawn.min(axis=1)
                        low = step if low is None else np.minimum(low, step)
                    low = mix(low.astype(np.uint64)).reshape(near.bands, near.rows)
                    bucket = salt.copy()
                    for r in range(near.rows):
                        bucket = mix(bucket + low[:, r])
                    kept = (low.ravel() & np.uint64((1 << near.bits) - 1)).astype(np.uint8)
                    packed = np.packbits(np.unpackbits(kept[:, None], axis=1, bitorder="little")[:, : near.bits])
                    out.append((len(hashes), _signed(one), _signed(two), bucket.view(np.int64), packed.tobytes()))
            n, one, two, bucket, packed = zip(*out, strict=True) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.array(bucket, pa.list_(pa.int64())), pa.array(packed, pa.binary())],
                names=["doc_id", "n_shingles", "h1", "h2", "buckets", "signature"],
            )

    return run


def _equal_entries(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Equal entries of packed signatures, rows of ``a`` against rows of ``b`` (broadcast)."""
    differ = np.unpackbits(a ^ b, axis=-1)
    entries = differ.shape[-1] // bits
    return entries - differ.reshape(*differ.shape[:-1], entries, bits).any(axis=-1).sum(axis=-1)


def _estimated(near: Near):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                for c in ("sig_a", "sig_b")
            )
            yield batch.select(["a", "h1_a", "b", "h1_b"]).filter(pa.array(_equal_entries(a, b, near.bits) >= near.least_equal))

    return run


def _tile_links(near: Near):
    """Links between components inside a tile pair: at most one per joined component.

    Members are compared across components only. A pair is left to the first band that holds both, the signature
    estimate drops most others, and the full sets decide: with the set of one member marked in
    the tile's vocabulary, a partner's common part is a sum over its own set.
    """

    def links(rows: list[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
        t = pa.Table.from_batches(rows)
        left, doc = t.column("left").to_numpy(), t.column("doc").to_numpy()
        component = t.column("component").to_numpy().copy()
        signature = np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint8).reshape(len(doc), -1)
        buckets = t.column("buckets").combine_chunks().flatten().to_numpy().reshape(len(doc), -1)
        band, same = t.column("band")[0].as_py(), t.column("i")[0].as_py() == t.column("j")[0].as_py()
        if not same and left.all() or component.min() == component.max():
            return
        held, names = zip(*_sets(t.column("text").combine_chunks(), near.width), strict=True)
        # Other texts of the same doc_id are left out.
        own = np.flatnonzero(np.array(names, np.int64) == t.column("h1").to_numpy())
        left, doc, component, signature, buckets = (v[own] for v in (left, doc, component, signature, buckets))
        held = [held[k] for k in own]
        x = np.flatnonzero(left)
        y = x if same else np.flatnonzero(~left)
        if not len(x) or not len(y):
            return
        size = np.array([len(h) for h in held])
        vocabulary, index = np.unique(np.concatenate(held), return_inverse=True)
        first, mark = np.cumsum(size) - size, np.zeros(len(vocabulary), bool)
        for k, at in enumerate(x):
            other = y[k + 1 :] if same else y
            other = other[component[other] != component[at]]
            other = other[(buckets[other, :band] != buckets[at, :band]).all(axis=1)]
            other = other[_equal_entries(signature[at][None], signature[other], near.bits) >= near.least_equal]
            if not len(other):
                continue
            own = index[first[at] : first[at] + size[at]]
            mark[own] = True
            common = np.add.reduceat(mark[index[ragged(first[other], size[other])]], np.cumsum(size[other]) - size[other], dtype=np.int64)
            mark[own] = False
            for hit in other[100 * common >= near.percent * (size[at] + size[other] - common)]:
                if component[hit] != component[at]:
                    yield int(doc[at]), int(doc[hit])
                    component[component == component[hit]] = component[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_groups(batches, ("bucket", "i", "j")):
            if found := list(links(rows)):
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[list[pa.RecordBatch]]:
    """Batches of each run of equal keys in a sorted stream."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield held
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield held


def _sets(column: pa.Array, width: int) -> Iterator[tuple[np.ndarray, int]]:
    """The shingles of each text, and its h1."""
    data, bounds = text_bytes(column)
    for i, j in slices(bounds, SLICE):
        for hashes, one, _ in shingle_sets(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], width):
            yield hashes, _signed(one)


def _confirmed(near: Near):
    """Pairs whose full sets are similar enough. Other texts of the same doc_id are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            named = (batch.column(c).to_pylist() for c in ("h1_a", "h1_b"))
            sets = (_sets(batch.column(c), near.width) for c in ("text_a", "text_b"))
            for h1_a, h1_b, (x, of_x), (y, of_y) in zip(*named, *sets, strict=True):
                if h1_a != of_x or h1_b != of_y:
                    keep.append(False)
                    continue
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(common > 0 and 100 * common >= near.percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def confirmed_links(pairs: DataFrame, texts: DataFrame, near: Near) -> DataFrame:
    """Those of ``pairs`` (a, h1_a, b, h1_b) that the full sets of their texts (doc, text) confirm, as a and b."""
    left = texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(_confirmed(near), "a long, b long")


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``docs`` needs ``doc_id`` and ``text``; further columns are ignored. Words are runs of bytes other than
    0x20 and 0x09-0x0D with A-Z lower-cased. A text of fewer words than a shingle is one shingle;
    null, empty or blank texts have none and link with nothing. Rows that share a ``doc_id`` are
    one node of the links, whatever their texts; a null ``doc_id`` links with nothing and is kept. Copies of a
    word sequence are linked through the smallest of them. An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(
        docs.mapInArrow(
            _signatures(near),
            "doc_id long, n_shingles long, h1 long, h2 long, buckets array<long>, signature binary",
        ),
        "signatures",
    )
    able = signed.where("n_shingles > 0 and doc_id is not null")
    # The smallest row of each word sequence stands for its copies; they are reduced before the shuffle.
    smallest = F.min(F.struct("doc_id", "buckets", "signature")).alias("m")
    reps = stored(
        able.groupBy("h1", "h2").agg(smallest)
        .select(F.col("m.doc_id").alias("doc"), "h1", "h2", "m.buckets", "m.signature"),
        "representatives",
    )
    copies = reps.select("h1", "h2", "doc")
    # A node that has several texts has several rows here; its signatures are told apart by h1.
    members = reps.select("doc", "h1", F.posexplode("buckets").alias("band", "bucket"))
    shared = stored(
        members.groupBy("bucket").agg(F.min(F.struct("doc", "h1")).alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1"),
        "buckets",
    )
    # Texts of representatives only: a node and the hash of its word sequence name one.
    key = F.struct("doc", "h1")
    named = reps.select(key.alias("k"), "signature")
    stars = (
        members.join(shared, "bucket")
        .where(key != F.col("first"))
        .select(F.col("first").alias("ka"), key.alias("kb"))
        .distinct()
    )
    estimated = (
        stars.join(named.select(F.col("k").alias("ka"), F.col("signature").alias("sig_a")), "ka")
        .join(named.select(F.col("k").alias("kb"), F.col("signature").alias("sig_b")), "kb")
        .select(
            F.col("ka.doc").alias("a"), F.col("ka.h1").alias("h1_a"), F.col("kb.doc").alias("b"), F.col("kb.h1").alias("h1_b"),
            "sig_a", "sig_b",
        )
        .mapInArrow(_estimated(near), "a long, h1_a long, b long, h1_b long")
    )
    texts = docs.where("doc_id is not null").select(F.col("doc_id").alias("doc"), "text")
    stars = stored(estimated.where("a <> b").distinct(), "star_candidates")
    # A doc_id with several texts joins the representatives of all of them.
    several = (
        signed.where("doc_id is not null").groupBy("doc_id")
        .agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"), F.count_if(F.col("h1").isNull()).alias("blank"))
        .where("lo <> hi or lo is not null and blank > 0").select("doc_id")
    )
    owned = stored(
        able.select("doc_id", "h1", "h2").join(several, "doc_id").distinct().join(copies, ["h1", "h2"])
        .select("doc_id", F.col("doc").alias("rep")),
        "several_texts",
    )
    own_links = owned.where("rep <> doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    links = stored(confirmed_links(stars, texts, near).unionByName(own_links), "star_links")
    placed = stored(components(links), "star_components")

    member = members.join(shared.where("size > 2"), "bucket").join(
        placed.withColumnRenamed("node", "doc"), "doc", "left"
    ).select("bucket", "band", "size", "doc", "h1", F.coalesce("component", "doc").alias("component"))
    open_buckets = (
        member.groupBy("bucket", "size").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo <> hi").select("bucket", F.ceil(F.col("size") / TILE).alias("tiles"))
    )
    tile = F.pmod(F.xxhash64("doc"), F.col("tiles"))
    tiled = (
        member.join(open_buckets, "bucket")
        .join(reps.select("doc", "h1", "signature", "buckets"), ["doc", "h1"])
        .join(texts, "doc")
        .withColumn("tile", tile)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .select(
            "bucket", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
            (F.col("tile") <= F.col("other")).alias("left"), "doc", "h1", "component", "band", "signature", "buckets", "text",
        )
        .repartition(spread(spark), "bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j")
    )
    more = tiled.mapInArrow(_tile_links(near), "a long, b long")
    label = lambda c, r: placed.select(F.col("node").alias(c), F.col("component").alias(r))
    more = stored(
        more.join(label("a", "ca"), "a", "left").join(label("b", "cb"), "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")),
        "tile_links",
    )
    joined = components(more)
    final = (
        reps.select("doc").distinct()
        .join(placed.withColumnRenamed("node", "doc"), "doc", "left")
        .select("doc", F.coalesce("component", "doc").alias("c1"))
        .join(joined.select(F.col("node").alias("c1"), F.col("component").alias("c2")), "c1", "left")
        .select(F.col("doc").alias("rep"), F.coalesce("c2", "c1").alias("component_id"))
    )
    # A blank text goes with the other texts of its doc_id.
    ids, blank = signed.select("doc_id", "n_shingles", "h1", "h2"), F.col("n_shingles") == 0
    placed_rows = ids.where(~blank).join(copies.withColumnRenamed("doc", "rep"), ["h1", "h2"], "left").unionByName(
        ids.where(blank).join(owned.groupBy("doc_id").agg(F.min("rep").alias("rep")), "doc_id", "left")
    )
    chosen = placed_rows.join(final, "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return chosen.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )
