"""Packing documents into sequences of a fixed window by non-negative least squares.

A document is cut into whole windows and a remainder. The histogram of remainder lengths (at
most one entry per length below the window) decides everything else: shallow combinations of
lengths that fill a window exactly are enumerated, non-negative least squares finds how often
to use each so that the histogram is met, the counts are rounded down to what is there, and
what is left is packed greedily, the longest first. The plan is a list of patterns whose size depends on the window alone. Pieces find
their place from their rank among pieces of their length, which is counted within salted
groups, so a length that a third of all documents have is spread like any other.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.kernels import slices, text_bytes
from siltstone.llm.tokens import encoder, word_bpe_path
from siltstone.session import stored

SLICE = 8 << 20
SALTS = 256


@dataclass(frozen=True)
class Packing:
    window: int = 4096
    end_id: int = 2
    depth: int = 3
    rounds: int = 200
    tokenizer: str = field(default_factory=word_bpe_path)


PIECE = "doc_id {id}, start long, length long, doc_tokens long, ids binary"


def _pieces(p: Packing):
    """Whole windows and the remainder of each document, with their ids (little-endian 32 bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(p.tokenizer)
        for batch in batches:
            _, bytes_ = text_bytes(batch.column("text"))
            for i, j in slices(bytes_, SLICE):
                ids, bounds = encode(batch.column("text").slice(i, j - i))
                docs, starts, lengths, totals, held = [], [], [], [], []
                for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    own = np.append(ids[a:b], np.uint32(p.end_id)).astype("<u4")
                    for at in range(0, len(own), p.window):
                        piece = own[at : at + p.window]
                        docs.append(i + k)
                        starts.append(at)
                        lengths.append(len(piece))
                        totals.append(len(own))
                        held.append(piece.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(docs, pa.int64())), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(totals, pa.int64()), pa.array(held, pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    return run


def combinations(have: np.ndarray, window: int, depth: int) -> list[tuple[int, ...]]:
    """Shallow combinations of present lengths that fill the window exactly.

    All pairs, and for deeper ones those that an evenly spread choice of first lengths allows, so that
    their number stays within a few per length.
    """
    lengths = np.flatnonzero(have)
    there = have > 0
    found = {(window,)} if window < len(have) and have[window] else set()
    found |= {(int(a), int(window - a)) for a in lengths if a * 2 <= window and window - a > 0 and there[window - a]}
    if depth >= 3 and len(lengths):
        common = lengths[np.argsort(-have[lengths], kind="stable")[:8]]
        even = lengths[np.unique(np.linspace(0, len(lengths) - 1, 8).astype(int))]
        for a in np.union1d(common, even):
            rest = window - a
            for b in lengths[lengths * 2 <= rest]:
                if rest - b > 0 and there[rest - b]:
                    found.add(tuple(sorted((int(a), int(b), int(rest - b)))))
    return sorted(found)


def nnls(combos: list[tuple[int, ...]], have: np.ndarray, rounds: int) -> np.ndarray:
    """Counts x >= 0 with the least squared distance between the used lengths and the histogram.

    Projected gradient steps with momentum on the sparse use matrix.
    """
    if not combos:
        return np.zeros(0)
    which = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    length = np.array([n for c in combos for n in c])
    target = have.astype(float)
    rows = np.bincount(length, minlength=len(have))
    step = 1.0 / (max(len(c) for c in combos) * max(1, rows.max()))
    x = y = np.zeros(len(combos))
    momentum = 1.0
    for _ in range(rounds):
        left = np.bincount(length, y[which], len(have)) - target
        nxt = np.maximum(0.0, y - step * np.bincount(which, left[length], len(combos)))
        grown = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        y = nxt + (momentum - 1) / grown * (nxt - x)
        x, momentum = nxt, grown
    return x


def plan(have: np.ndarray, p: Packing) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of ascending lengths, and how often each is used, so that every piece is used once.

    ``have[n]``: pieces of length ``n``.
    """
    left = have.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []

    def most(pattern: tuple[int, ...]) -> int:
        return min(int(left[n]) // pattern.count(n) for n in set(pattern))

    def use(pattern: tuple[int, ...], times: int) -> None:
        for n in pattern:
            left[n] -= times
        out.append((tuple(sorted(pattern)), times))

    combos = combinations(left, p.window, p.depth)
    wanted = np.floor(nnls(combos, left, p.rounds) + 0.5).astype(np.int64)
    for k in np.argsort(-wanted, kind="stable"):
        times = min(int(wanted[k]), most(combos[k]))
        if times > 0:
            use(combos[k], times)
    # Residuals: the longest piece first, then the longest that still fit, as often as counts allow.
    while left.any():
        room, pattern, spare = p.window, [], left.copy()
        while room > 0 and len(fits := np.flatnonzero(spare[: room + 1])):
            n = int(fits[-1])
            many = min(room // n, int(spare[n]))
            pattern += [n] * many
            spare[n] -= many
            room -= many * n
        use(tuple(pattern), most(tuple(pattern)))
    return out


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length rows (first rank, pieces per sequence, first sequence, offset of the first)."""
    rows, ranks, sequence = defaultdict(list), defaultdict(int), 0
    for pattern, times in patterns:
        at = 0
        for n in sorted(set(pattern)):
            many = pattern.count(n)
            rows[n].append((ranks[n], many, sequence, at))
            ranks[n] += many * times
            at += many * n
        sequence += times
    return {n: np.array(r, np.int64) for n, r in rows.items()}


def _placed(places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own, table = length == n, places.value[int(n)]
                row = table[np.searchsorted(table[:, 0], rank[own], "right") - 1]
                use, slot = np.divmod(rank[own] - row[:, 0], row[:, 1])
                sequence[own], offset[own] = row[:, 2] + use, row[:, 3] + slot * n
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, packing: Packing | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids, sequence_id, offset.

    ``docs`` needs ``doc_id`` and ``text``; further columns are ignored. A document is the ids of its text and the end
    id; null and empty texts are the end id alone. ``ids`` holds a piece as little-endian unsigned 32-bit numbers.
    Each id of each row lies in one piece, so repeated rows and ids are packed again, null ids as well; pieces of equal
    length, document and start take their places in the order of their ids. Sequences have at most
    ``window`` ids and are gapless from offset 0. An empty table gives no rows.
    """
    p = packing or Packing()
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = PIECE.format(id=kind)
    pieces = stored(
        docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .mapInArrow(_pieces(p), columns)
        .withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "doc_tokens"), F.lit(SALTS))),
        "pieces",
    )
    counts = pieces.groupBy("length", "salt").count()
    have = np.zeros(p.window + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("count").alias("n")).collect():
        have[row["length"]] = row["n"]
    places = spark.sparkContext.broadcast(_places(plan(have, p)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "doc_tokens", "ids")
    ranked = (
        pieces.withColumn("row", F.row_number().over(inside))
        .join(base, ["length", "salt"])
        .select("doc_id", "start", "length", "doc_tokens", "ids", (F.col("base") + F.col("row") - 1).alias("rank"))
    )
    return ranked.mapInArrow(_placed(places), columns + ", sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, ids. At most a window per row."""
    held = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.aggregate(held, F.lit(b""), lambda all_, piece: F.concat(all_, piece["ids"])).alias("ids")
    )
