"""Removal of long byte strings that also start in an earlier document.

Sparse suffix arrays: a suffix is indexed where its head is the smallest fingerprint among
the heads of a window, so every string of ``width`` bytes holds an indexed position and equal
strings hold it at the same place. The indexed positions are dealt out by head. In each part
documents come in batches of ascending ids. A batch gets a sorted suffix array, which is
merge-scanned against the levels of a logarithmic index family; then it joins the family, and
levels of equal size merge, so an entry is merged a logarithmic number of times.

A scan finds heads that other documents have too. Only their surroundings (the windows of
``width`` bytes that the position stands for) travel in a second step, are sorted, and give the
exact covered windows. Copies within a batch of the scan are resolved where they are read, so
a passage of very many documents sends one entry per batch. Strings are compared by a 64-bit
fingerprint of the head and one of the whole.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import LAST, spread
from siltstone.llm.kernels import Rolling, leftmost_minima, mix, ragged, slices, text_bytes

SLICE = 1 << 20
PACKED = "part int, kind int, a binary, b binary, c binary, d binary, e binary"
NAMES = ["part", "kind", "a", "b", "c", "d", "e"]


@dataclass(frozen=True)
class Strings:
    """``width``: shortest removed string; ``head``: bytes that order the suffixes; ``batches`` per index."""

    width: int = 50
    head: int = 20
    batches: int = 8

    def __post_init__(self):
        if not 0 < self.head <= self.width < 1 << 15:
            raise ValueError("a head has at least one byte and at most the width, a width less than 32768 bytes")


@dataclass
class Samples:
    """Indexed positions: document, number in it, first and last window start, distance to the head, fingerprints."""

    doc: np.ndarray
    ordinal: np.ndarray
    start: np.ndarray
    last: np.ndarray
    shift: np.ndarray
    head: np.ndarray
    whole: np.ndarray | None

    def take(self, chosen: np.ndarray) -> Samples:
        pick = lambda x: None if x is None else x[chosen]
        return Samples(*map(pick, vars(self).values()))


def _piece(data: np.ndarray, bounds: np.ndarray, s: Strings, whole: bool) -> Samples | None:
    if len(data) < s.width:
        return None
    rolling = Rolling(data)
    heads = rolling.windows(s.head)
    chosen = leftmost_minima(heads, s.width - s.head + 1)
    crossing = np.zeros(len(data) + 1, np.int32)
    inner = bounds[1:-1]
    np.add.at(crossing, np.maximum(inner - s.width + 1, 0), 1)
    np.add.at(crossing, inner, -1)
    valid = (np.cumsum(crossing) == 0)[: len(chosen)]
    turn = np.ones(len(chosen) + 1, bool)
    turn[1:-1] = (chosen[1:] != chosen[:-1]) | (valid[1:] != valid[:-1])
    start = np.flatnonzero(turn[:-1] & valid)
    last = np.flatnonzero(turn[1:] & valid)
    doc = np.searchsorted(bounds, start, "right") - 1
    ordinal = np.arange(len(start)) - np.searchsorted(doc, doc)
    return Samples(
        doc, ordinal, start - bounds[doc], last - bounds[doc], chosen[start] - start, heads[chosen[start]],
        rolling.spans(start, last + s.width) if whole else None,
    )


def sampled(data: np.ndarray, bounds: np.ndarray, s: Strings, whole: bool = False) -> Iterator[Samples]:
    """Indexed positions of all documents; a document longer than a slice is read in overlapping pieces."""
    for i, j in slices(bounds, SLICE):
        if bounds[j] - bounds[i] <= SLICE or j - i > 1:
            got = _piece(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], s, whole)
            if got:
                got.doc += i
                yield got
            continue
        size, before = int(bounds[j] - bounds[i]), 0
        for at in range(0, size - s.width + 1, SLICE):
            own = data[bounds[i] + at : bounds[i] + min(size, at + SLICE + s.width - 1)]
            got = _piece(own, np.array([0, len(own)]), s, whole)
            got.doc += i
            got.ordinal += before
            got.start += at
            got.last += at
            before += len(got.doc)
            yield got


def joined(parts: list[Samples]) -> Samples:
    columns = zip(*(vars(p).values() for p in parts), strict=True)
    return Samples(*(None if c[0] is None else np.concatenate(c) for c in columns))


def squeeze(data: np.ndarray) -> bytes:
    """Bytes of an array, compressed better than a shuffle does."""
    raw = data.tobytes()
    return struct.pack("<Q", len(raw)) + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueeze(data: pa.Buffer, kind: type) -> np.ndarray:
    (size,) = struct.unpack_from("<Q", data)
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd"), kind)


def delta(values: np.ndarray, kind: type = np.int64) -> bytes:
    return squeeze(np.diff(values, prepend=values.dtype.type(0)).astype(kind))


def undelta(data: pa.Buffer, kind: type = np.int64) -> np.ndarray:
    return np.cumsum(unsqueeze(data, kind), dtype=np.int64)


def dealt(part: np.ndarray, kind: int, columns: list) -> Iterator[tuple]:
    """Rows of each part: the columns' entries, packed by their function."""
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(part)], strict=True):
        chosen = order[a:b]
        packed = [pack(chosen) for pack in columns]
        yield (int(part[a]), kind, *packed, *[None] * (5 - len(packed)))


def packed_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    columns = zip(*rows, strict=True) if rows else [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=NAMES)


def short(values: np.ndarray) -> bytes:
    """The low 48 bits of fingerprints. Equal ones of different heads only send surroundings in vain."""
    return values.astype("<u4").tobytes() + (values >> np.uint64(32)).astype("<u2").tobytes()


def unshort(data: bytes) -> np.ndarray:
    n = len(data) // 6
    low, high = np.frombuffer(data, "<u4", n), np.frombuffer(data, "<u2", n, 4 * n)
    return low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))


def doc_part(doc: np.ndarray, parts: int) -> np.ndarray:
    return (mix(doc.astype(np.uint64)) % np.uint64(parts)).astype(np.int32)


def first_of_runs(*columns: np.ndarray) -> np.ndarray:
    """Which rows of sorted columns differ from the row before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def run_of(new: np.ndarray) -> np.ndarray:
    """For each row the index of its run's first row."""
    return np.flatnonzero(new)[np.cumsum(new) - 1]


def _heads(s: Strings, parts: int):
    """Per batch one entry of each head, dealt by head (kind 0), and positions repeated inside it (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            found = list(sampled(data, bounds, s))
            if not found:
                continue
            x = joined(found)
            x.head &= np.uint64((1 << 48) - 1)
            doc = batch.column("pos").to_numpy()[x.doc]
            order = np.lexsort((doc, x.head))
            x, doc = x.take(order), doc[order]
            first = run_of(first_of_runs(x.head))
            other = doc != doc[first]
            repeated = np.zeros(len(doc), bool)
            repeated[first[other]] = True
            repeated |= other
            # The first document may hold a head several times.
            repeated |= repeated[first]
            sent = ~other
            back = np.flatnonzero(repeated)
            rows = list(_positions(doc[back], x.ordinal[back], parts, 1))
            keep = np.flatnonzero(sent)
            keep = keep[np.lexsort((x.ordinal[keep], doc[keep]))]
            head, doc, ordinal = x.head[keep], doc[keep], x.ordinal[keep]
            rows += dealt(
                (head % np.uint64(parts)).astype(np.int32), 0,
                [lambda i: short(head[i]), lambda i: delta(doc[i]), lambda i: delta(ordinal[i], np.int32)],
            )
            yield packed_rows(rows)

    return run


def _positions(doc: np.ndarray, ordinal: np.ndarray, parts: int, kind: int) -> Iterator[tuple]:
    order = np.lexsort((ordinal, doc))
    doc, ordinal = doc[order], ordinal[order]
    return dealt(doc_part(doc, parts), kind, [lambda i: delta(doc[i]), lambda i: delta(ordinal[i], np.int32)])


def repeated_heads(head: np.ndarray, doc: np.ndarray, batch: np.ndarray) -> np.ndarray:
    """Entries whose head another document has, by a family of levels that double in size.

    A level is a suffix array: ascending heads and, for each, the entry of its smallest document.
    """
    hit = np.zeros(len(head), bool)
    levels: list[tuple[int, np.ndarray, np.ndarray]] = []
    for number in np.unique(batch):
        own = np.flatnonzero(batch == number)
        own = own[np.lexsort((doc[own], head[own]))]
        new = first_of_runs(head[own])
        first = own[run_of(new)]
        other = doc[own] != doc[first]
        hit[own[other]] = True
        hit[first[other]] = True
        for _, heads, owners in levels:
            at = np.minimum(np.searchsorted(heads, head[own]), len(heads) - 1)
            same = heads[at] == head[own]
            same &= doc[owners[at]] != doc[own]
            hit[own[same]] = True
            hit[owners[at[same]]] = True
        level = (1, head[own[new]], own[new])
        while levels and levels[-1][0] <= level[0]:
            size, heads, owners = levels.pop()
            both, who = np.concatenate([heads, level[1]]), np.concatenate([owners, level[2]])
            order = np.argsort(both, kind="stable")
            both, who = both[order], who[order]
            new = first_of_runs(both)
            level = (size + level[0], both[new], who[new])
        levels.append(level)
    # A document may hold a repeated head more than once.
    order = np.argsort(head, kind="stable")
    run = np.cumsum(first_of_runs(head[order])) - 1
    any_hit = np.zeros(int(run[-1]) + 1 if len(run) else 0, bool)
    any_hit[run[hit[order]]] = True
    hit[order] = any_hit[run]
    return hit


def _scan(cuts: list[int], parts: int):
    """Repeated positions of a part (kind 1), and those passed through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, doc, ordinal = [], [], []
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            passed = batch.filter(pa.array(kind == 1))
            if passed.num_rows:
                yield passed
            for a, b, c in zip(*(batch.filter(pa.array(kind == 0)).column(k) for k in "abc"), strict=True):
                head.append(unshort(a.as_buffer()))
                doc.append(undelta(b.as_buffer()))
                ordinal.append(undelta(c.as_buffer(), np.int32))
        if head:
            head, doc, ordinal = map(np.concatenate, (head, doc, ordinal))
            hit = repeated_heads(head, doc, np.searchsorted(cuts, doc))
            yield packed_rows(list(_positions(doc[hit], ordinal[hit], parts, 1)))

    return run


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document of a part, with its repeated positions."""
    doc, ordinal = [], []
    for batch in batches:
        for a, b in zip(batch.column("a"), batch.column("b"), strict=True):
            doc.append(undelta(a.as_buffer()))
            ordinal.append(undelta(b.as_buffer(), np.int32))
    if doc:
        doc, ordinal = np.concatenate(doc), np.concatenate(ordinal)
    if len(doc):
        order = np.lexsort((ordinal, doc))
        doc, ordinal = doc[order], ordinal[order]
        new = first_of_runs(doc, ordinal)
        doc, ordinal = doc[new], ordinal[new]
        cuts = np.flatnonzero(first_of_runs(doc))
        held = [delta(ordinal[a:b], np.int32) for a, b in zip(cuts, [*cuts[1:], len(doc)], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(doc[cuts]), pa.array(held, pa.binary())], names=["pos", "ordinals"])


def _surroundings(s: Strings, parts: int):
    """The windows of repeated positions, dealt by head (kind 0); those copied inside a batch (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            wanted = [undelta(o.as_buffer(), np.int32) for o in batch.column("ordinals")]
            docs = np.repeat(np.arange(len(wanted)), [len(o) for o in wanted])
            wanted = docs * (1 << 40) + (np.concatenate(wanted) if wanted else docs)
            found = []
            for x in sampled(data, bounds, s, whole=True):
                key = x.doc * (1 << 40) + x.ordinal
                at = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
                found.append(x.take(np.flatnonzero(wanted[at] == key)) if len(wanted) else x.take(np.zeros(0, int)))
            if not found:
                continue
            x = joined(found)
            pos, text = batch.column("pos").to_numpy()[x.doc], batch.column("text_hash").to_numpy()[x.doc]
            order = np.lexsort((pos, x.whole, x.head))
            x, pos, text = x.take(order), pos[order], text[order]
            first = run_of(first_of_runs(x.head, x.whole))
            copied = pos != pos[first]
            rows = list(_covered(pos[copied], text[copied], x.start[copied], x.last[copied] + s.width, parts))
            keep = np.flatnonzero(~copied)
            keep = keep[np.lexsort((x.start[keep], text[keep], pos[keep]))]
            x, pos, text = x.take(keep), pos[keep], text[keep]
            begin, length = bounds[x.doc] + x.start, x.last - x.start + s.width
            rows += dealt(
                (x.head % np.uint64(parts)).astype(np.int32), 0,
                [
                    lambda i: delta(pos[i]),
                    lambda i: delta(text[i]),
                    lambda i: delta(x.start[i]),
                    lambda i: squeeze(np.concatenate([x.shift[i], length[i]]).astype(np.uint16)),
                    lambda i: squeeze(data[ragged(begin[i], length[i])]),
                ],
            )
            yield packed_rows(rows)

    return run


def _covered(pos, text, start, end, parts: int) -> Iterator[tuple]:
    columns = [pos, text, start.astype(np.int64), end.astype(np.int64)]
    return dealt(doc_part(pos, parts), 1, [lambda i, c=c: c[i].tobytes() for c in columns])


def _compare(s: Strings, parts: int):
    """Covered ranges: surroundings, and single windows, that an earlier document has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in range(6)]
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            passed = batch.filter(pa.array(kind == 1))
            if passed.num_rows:
                yield passed
            for row in zip(*(batch.filter(pa.array(kind == 0)).column(k) for k in "abcde"), strict=True):
                a, b, c, d, e = (v.as_buffer() for v in row)
                for own, x in zip(held, (
                    undelta(a), undelta(b), undelta(c), *unsqueeze(d, np.uint16).astype(np.int64).reshape(2, -1),
                    unsqueeze(e, np.uint8),
                ), strict=True):
                    own.append(x)
        if not held[0]:
            return
        pos, text, start, shift, length, data = map(np.concatenate, held)
        begin = np.cumsum(length) - length
        head, whole = _fingerprints(data, begin, length, shift, s.head)
        order = np.lexsort((pos, whole, head))
        head, whole, pos, text, start, length, begin = (
            v[order] for v in (head, whole, pos, text, start, length, begin)
        )
        new = first_of_runs(head, whole)
        copied = pos != pos[run_of(new)]
        yield packed_rows(list(_covered(pos[copied], text[copied], start[copied], start[copied] + length[copied], parts)))
        # Heads with different surroundings: their single windows are compared.
        run_new = first_of_runs(head)
        kinds = np.add.reduceat(new, np.flatnonzero(run_new))
        mixed = (kinds > 1)[np.cumsum(run_new) - 1] & ~copied
        at = np.flatnonzero(mixed)
        for chosen in np.array_split(at, max(1, len(at) // 50_000)) if len(at) <= 50_000 else _runs(at, head, 50_000):
            rows = _windows(chosen, data, begin, length, pos, text, start, s, parts)
            if rows:
                yield packed_rows(rows)

    return run


def _fingerprints(data, begin, length, shift, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the head and of the whole of each entry of ``data``."""
    head, whole = np.empty(len(begin), np.uint64), np.empty(len(begin), np.uint64)
    bounds = np.append(begin, len(data))
    for i, j in slices(bounds, SLICE):
        rolling, at = Rolling(data[bounds[i] : bounds[j]]), begin[i:j] - bounds[i]
        head[i:j] = rolling.spans(at + shift[i:j], at + shift[i:j] + width)
        whole[i:j] = rolling.spans(at, at + length[i:j])
    return head, whole


def _runs(at: np.ndarray, head: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Slices of about ``size`` entries that keep the entries of a head together."""
    starts = np.flatnonzero(first_of_runs(head[at]))
    first = 0
    while first < len(at):
        k = np.searchsorted(starts, first + size)
        last = int(starts[k]) if k < len(starts) else len(at)
        yield at[first:last]
        first = last


def _windows(at, data, begin, length, pos, text, start, s: Strings, parts: int) -> list[tuple]:
    if not len(at):
        return []
    bytes_ = data[ragged(begin[at], length[at])]
    own = np.cumsum(length[at]) - length[at]
    count = length[at] - s.width + 1
    window = Rolling(bytes_).windows(s.width)[ragged(own, count)]
    entry = np.repeat(at, count)
    offset = ragged(np.zeros(len(at), np.int64), count)
    order = np.lexsort((pos[entry], window))
    window, entry, offset = window[order], entry[order], offset[order]
    earlier = pos[entry] != pos[entry][run_of(first_of_runs(window))]
    entry, offset = entry[earlier], offset[earlier]
    order = np.lexsort((offset, entry))
    entry, offset = entry[order], offset[order]
    # Runs of windows become one range.
    new = np.ones(len(entry), bool)
    new[1:] = (entry[1:] != entry[:-1]) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(new)
    final = np.append(first[1:], len(entry)) - 1 if len(first) else first
    who = entry[first]
    return list(_covered(pos[who], text[who], start[who] + offset[first], start[who] + offset[final] + s.width, parts))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document of a part with the united covered ranges of each of its texts."""
    held: list[list[np.ndarray]] = [[] for _ in range(4)]
    for batch in batches:
        for own, name in zip(held, "abcd", strict=True):
            own += [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column(name)]
    if not held[0]:
        return
    pos, text, start, end = map(np.concatenate, held)
    if not len(pos):
        return
    order = np.lexsort((start, text, pos))
    pos, text, start, end = pos[order], text[order], start[order], end[order]
    fresh = first_of_runs(pos, text)
    # Ends only grow within a text: shift texts apart, take the running maximum, shift back.
    run = np.cumsum(fresh) - 1
    apart = run * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + apart) - apart
    new = fresh.copy()
    new[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    final = np.append(first[1:], len(pos)) - 1
    pos, text, start, end = pos[first], text[first], start[first], reach[final]
    cuts = np.flatnonzero(first_of_runs(pos))
    triples = np.stack([text, start, end])
    held = [triples[:, a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(pos)], strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array(pos[cuts]), pa.array(held, pa.binary())], names=["pos", "ranges"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        data, bounds = text_bytes(batch.column("text"))
        spans, kept = [], []
        for i, (ranges, text) in enumerate(zip(batch.column("ranges"), batch.column("text_hash").to_pylist(), strict=True)):
            own = data[bounds[i] : bounds[i + 1]]
            found = []
            if ranges.is_valid:
                texts, start, end = np.frombuffer(ranges.as_buffer(), np.int64).reshape(3, -1)
                found = [(int(a), int(b)) for t, a, b in zip(texts, start, end, strict=True) if t == text]
            gone = np.zeros(len(own), bool)
            for a, b in found:
                gone[a:b] = True
            spans.append([{"start": a, "end": b} for a, b in found])
            kept.append(own[~gone].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(spans, span), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "removed", "kept"],
        )


def drop_repeated_strings(docs: DataFrame, strings: Strings = Strings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, removed (ranges of bytes), kept (the other bytes).

    ``docs`` needs ``doc_id`` and ``text``; further columns are ignored. A text counts as its UTF-8 bytes, null as
    none. A byte goes if a string of ``width`` bytes over it also starts in a document with a smaller ``doc_id``,
    judged on the input. Rows with equal ``doc_id`` do not count against each other; a null ``doc_id`` counts as
    larger than all others. An empty table gives no rows. Memory is bounded by a part's share of the
    indexed positions; their number of parts is ``spark.sql.shuffle.partitions``.
    """
    spark = docs.sparkSession
    parts = spread(spark)
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("pos"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    shares = [k / strings.batches for k in range(1, strings.batches)]
    cuts = docs.agg(F.percentile_approx("pos", shares, 10_000).alias("c")).first()["c"] or []
    by_part = lambda df: df.repartitionById(parts, F.col("part"))

    heads = by_part(docs.select("pos", "text").mapInArrow(_heads(strings, parts), PACKED))
    repeated = by_part(heads.mapInArrow(_scan(sorted(set(cuts)), parts), PACKED))
    ordinals = repeated.mapInArrow(_per_document, "pos long, ordinals binary")
    # Both joins take the texts from one exchange.
    texts = docs.withColumn("text_hash", F.xxhash64("text"))
    wide = texts.join(ordinals, "pos")
    around = by_part(wide.mapInArrow(_surroundings(strings, parts), PACKED))
    covered = by_part(around.mapInArrow(_compare(strings, parts), PACKED))
    ranges = covered.mapInArrow(_ranges, "pos long, ranges binary")
    return texts.join(ranges, "pos", "left").select("doc_id", "text_hash", "text", "ranges").mapInArrow(
        _cut, "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
    )
