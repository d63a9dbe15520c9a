"""Source divergence audit: how far the term frequencies of sources lie apart, by single-pass in-memory indexing.

Tasks read texts into an in-memory index of (term, group) postings until it is full, spill it as a run sorted by
term and cut by hash shard, and start anew. Runs are dealt out by shard; a task takes the pieces of a shard in the order
of their first term and merges them with a heap of the open ones, many postings at a time, so that only overlapping
pieces are held. Its frequencies are exact, and terms of too few documents go there and then.

Smoothed frequencies make a pair of sources differ in every term of their language, also in those that neither has.
The sum over all terms starts from that constant and is corrected: for the terms one source has (grouped by
equal frequency), and, streaming through the frequencies term by term, for those that both have.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.frames import spread
from siltstone.llm.kernels import slices, text_bytes
from siltstone.llm.lexicon import LETTERS, coded_terms
from siltstone.session import stored

SLICE = 1 << 22  # bytes of text that are indexed at a time
MEMORY = 1 << 26  # bytes of an in-memory index before it is spilled
PIECE = 1 << 10  # postings in a piece of a run
FLUSH = 1 << 16  # postings that are merged at a time
PAIRS = 1 << 20  # pairs of sources in the corrections at a time
SCALE = 1_000_000_000
ENTRY, TERM = 32, 120  # estimated bytes of a posting and of a term in the lexicon


class Block:
    """An in-memory index: counts of occurrences and documents for each term and group."""

    def __init__(self) -> None:
        self.terms: dict[str, int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.postings = np.zeros((4, 0), np.int64)  # term, group, occurrences, documents
        self.fresh: list[np.ndarray] = []

    def add(self, terms: list[str], codes: np.ndarray, doc: np.ndarray, group: np.ndarray) -> None:
        """Terms of some documents: ``codes`` and ``doc`` of each occurrence, ``group`` of each document."""
        size = max(1, len(terms))
        once, times = np.unique(doc * size + codes, return_counts=True)
        pair, place = np.unique(group[once // size] * size + once % size, return_inverse=True)
        number = np.fromiter((self.terms.setdefault(t, len(self.terms)) for t in terms), np.int64, len(terms))
        count = np.bincount(place, times, len(pair)).astype(np.int64)
        self.fresh.append(np.stack([number[pair % size], pair // size, count, np.bincount(place, minlength=len(pair))]))

    def held(self) -> int:
        """Estimated bytes, after adding up equal postings if the fresh ones are many."""
        if sum(f.shape[1] for f in self.fresh) > self.postings.shape[1] + PIECE:
            self._add_up()
        return ENTRY * (self.postings.shape[1] + sum(f.shape[1] for f in self.fresh)) + TERM * len(self.terms)

    def _add_up(self) -> None:
        every = np.concatenate([self.postings, *self.fresh], axis=1)
        order = np.lexsort((every[1], every[0]))
        every = every[:, order]
        new = np.flatnonzero(np.any(np.diff(every[:2], axis=1, prepend=-1) != 0, axis=0))
        sums = np.add.reduceat(every[2:], new, axis=1) if len(new) else every[2:]
        self.postings, self.fresh = np.concatenate([every[:2, new], sums]), []

    def run(self, shards: int, number: int, piece: int) -> pa.RecordBatch:
        """All postings as pieces of one shard and at most ``piece`` each, in the order of terms, then languages and sources."""
        self._add_up()
        names, groups = pa.array(list(self.terms), pa.string()), list(self.groups)
        shard = np.array([crc32(t.encode()) % shards for t in self.terms], np.int64)
        rank = np.argsort(np.asarray(pc.sort_indices(names)))
        place = np.argsort(np.array(sorted(range(len(groups)), key=groups.__getitem__), np.int64))
        term, group, count, docs = self.postings
        order = np.lexsort((place[group], rank[term], shard[term]))
        term, group, count, docs = term[order], group[order], count[order], docs[order]
        new = np.flatnonzero(np.diff(shard[term], prepend=-1))
        size = np.diff(new, append=len(term))
        cuts = np.concatenate([np.arange(a, a + n, piece) for a, n in zip(new, size, strict=True)])
        offsets = pa.array(np.append(cuts, len(term)), pa.int32())
        lang, source = (pa.array([g[k] for g in groups], pa.string()).take(pa.array(group)) for k in (0, 1))
        texts = names.take(pa.array(term))
        lists = [pa.ListArray.from_arrays(offsets, x) for x in (texts, lang, source, pa.array(count), pa.array(docs))]
        ids = [pa.array(shard[term[cuts]], pa.int32()), pa.array(np.full(len(cuts), number)), texts.take(pa.array(cuts))]
        return pa.RecordBatch.from_arrays([*ids, *lists], schema=PIECES)


PIECES = pa.schema([
    ("shard", pa.int32()), ("run", pa.int64()), ("first", pa.string()), ("term", pa.list_(pa.string())),
    ("lang", pa.list_(pa.string())), ("source", pa.list_(pa.string())), ("n", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64())),
])
POSTING = ("term", "lang", "source", "n", "docs")
PIECES_DDL = (
    "shard int, run long, first string, term array<string>, lang array<string>, source array<string>, n array<long>, docs array<long>"
)
FREQUENCIES_DDL = "lang string, term string, source string, n long, lang_n long, lead boolean"


def runs(docs: DataFrame, shards: int, memory: int = MEMORY) -> DataFrame:
    """Term-sorted runs of (lang, source, text), as pieces of one hash shard each."""

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, block = TaskContext.get().partitionId() << 32, Block()
        for batch in batches:
            names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            names = [(lang or "", source or "") for lang, source in names]
            data, bounds = text_bytes(batch.column(2))
            for first, last in slices(bounds, SLICE):
                start, end = bounds[first], bounds[last]
                terms, codes, words = coded_terms(data[start:end], bounds[first : last + 1] - start, LETTERS)
                doc = np.repeat(np.arange(last - first), np.diff(words))
                group = [block.groups.setdefault(n, len(block.groups)) for n in names[first:last]]
                block.add(terms.to_pylist(), codes, doc, np.array(group, np.int64))
                if block.held() > memory:
                    yield block.run(shards, run, PIECE)
                    run, block = run + 1, Block()
        if block.terms:
            yield block.run(shards, run, PIECE)

    return docs.select("lang", "source", "text").mapInArrow(indexed, PIECES_DDL)


def _below(terms: pa.ChunkedArray, bound: str) -> int:
    """How many of the ascending terms are smaller than ``bound``."""
    return bisect_left(range(len(terms)), bound, key=lambda i: terms[i].as_py())


def merged(pieces: Iterable[tuple[int, str, pa.Table]], least: int = FLUSH) -> Iterator[pa.Table]:
    """Postings of complete terms, about ``least`` at a time, from pieces (shard, first term, postings) in that order.

    A heap holds the open pieces by their next term. Terms below the first one of the piece to come are complete: the heads
    of the pieces that hold some are taken off, and what is left of a piece goes back. Only overlapping pieces are open.
    """
    heap: list[tuple[str, int, pa.Table]] = []
    shard, waiting, number = None, 0, 0

    def ready(bound: str | None) -> pa.Table:
        nonlocal number
        heads = []
        while heap and (bound is None or heap[0][0] < bound):
            _, _, piece = heapq.heappop(heap)
            cut = len(piece) if bound is None else _below(piece["term"], bound)
            heads.append(piece.slice(0, cut))
            if cut < len(piece):
                number += 1
                heapq.heappush(heap, (piece["term"][cut].as_py(), number, piece.slice(cut)))
        return pa.concat_tables(heads)

    for own, first, piece in pieces:
        bound = first if own == shard else None
        if heap and (bound is None or waiting >= least and heap[0][0] < bound):
            yield ready(bound)
            waiting = sum(len(p) for _, _, p in heap)
        number += 1
        heapq.heappush(heap, (first, number, piece))
        shard, waiting = own, waiting + len(piece)
    if heap:
        yield ready(None)


def _reduced(postings: pa.Table, least_docs: int) -> list[pa.Array]:
    """Columns of the frequencies, of terms in enough documents, from all postings of some terms."""
    names, codes = {}, {}
    for c in ("term", "lang", "source"):
        coded = postings[c].combine_chunks().dictionary_encode()
        names[c], codes[c] = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
    per_lang = codes["term"] * len(names["lang"]) + codes["lang"]
    key = per_lang * len(names["source"]) + codes["source"]
    order = np.argsort(key, kind="stable")
    key, per_lang = key[order], per_lang[order]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    n, docs = (np.add.reduceat(np.asarray(postings[c])[order], new) for c in ("n", "docs"))
    key, per_lang = key[new], per_lang[new]
    lead = np.diff(per_lang, prepend=-1) != 0
    first = np.flatnonzero(lead)
    size = np.diff(first, append=len(key))
    enough = np.repeat(np.add.reduceat(docs, first) >= least_docs, size)
    total = np.repeat(np.add.reduceat(n, first), size)
    at = {"source": key % len(names["source"]), "lang": per_lang % len(names["lang"]), "term": per_lang // len(names["lang"])}
    lang, term, source = (names[c].take(pa.array(at[c][enough])) for c in ("lang", "term", "source"))
    return [lang, term, source, pa.array(n[enough]), pa.array(total[enough]), pa.array(lead[enough])]


def frequencies(docs: DataFrame, least_docs: int = 3, shards: int | None = None, memory: int = MEMORY) -> DataFrame:
    """Rows (lang, term, source, n, lang_n, lead) of terms in at least ``least_docs`` documents of a language.

    ``n`` counts a source's occurrences, ``lang_n`` those of the language; ``lead`` marks one row for each (lang, term).
    """
    parts = spread(docs.sparkSession)
    pieces = runs(docs, shards or 8 * parts, memory)
    pieces = pieces.repartition(parts, "shard").sortWithinPartitions("shard", "first", "run")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, pa.Table]]:
        for batch in batches:
            for k in range(len(batch)):
                columns = {c: batch.column(c)[k].values for c in POSTING}
                yield batch.column("shard")[k].as_py(), batch.column("first")[k].as_py(), pa.table(columns)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in FREQUENCIES_DDL.split(", ")]
        for postings in merged(opened(batches)):
            yield pa.RecordBatch.from_arrays(_reduced(postings, least_docs), names=names)

    return stored(pieces.mapInArrow(reduced, FREQUENCIES_DDL), "frequencies")


def _share(n: Column, total: Column) -> Column:
    """Smoothed share in parts of ``SCALE``; decimals, as the product leaves 64 bits beyond nine billion occurrences."""
    parts = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    whole = F.greatest(total, F.lit(1)).cast("decimal(20,0)")
    return F.call_function("div", parts, whole) + 1


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _both(entries: DataFrame) -> DataFrame:
    """Corrections for terms that both sources have, added up per pair: (lang, source, item, value)."""
    fields = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // q

    def corrected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        sums: dict[tuple[int, int], int] = {}

        def out() -> pa.RecordBatch:
            names = list(groups)
            rows = [(*names[a], names[b][1], v) for (a, b), v in sums.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, fields, strict=True)], schema=fields)

        def take(table: pa.Table) -> Iterator[pa.RecordBatch]:
            """Whole (lang, term) groups, in order."""
            names = zip(table["lang"].to_pylist(), table["source"].to_pylist(), strict=True)
            code = np.fromiter((groups.setdefault(x, len(groups)) for x in names), np.int64, len(table))
            p, p0 = np.asarray(table["p"]), np.asarray(table["p0"])
            first = np.flatnonzero(_changes(table))
            size = np.diff(first, append=len(table))
            start, many = np.repeat(first, size), np.repeat(size, size)
            row = 0
            upto = np.cumsum(many)
            while row < len(code):
                end = max(row + 1, int(np.searchsorted(upto, (upto[row - 1] if row else 0) + PAIRS, "right")))
                a = np.repeat(np.arange(row, end), many[row:end])
                b = np.arange(len(a)) - np.repeat(np.cumsum(many[row:end]) - many[row:end], many[row:end]) + start[a]
                a, b = a[a != b], b[a != b]
                value = f(p[a], p[b]) - f(p[a], p0[b]) - f(p0[a], p[b]) + f(p0[a], p0[b])
                pair, place = np.unique(code[a] * len(groups) + code[b], return_inverse=True)
                total = np.zeros(len(pair), np.int64)
                np.add.at(total, place, value)
                for key, more in zip(pair.tolist(), total.tolist(), strict=True):
                    key = divmod(key, len(groups))
                    sums[key] = sums.get(key, 0) + more
                if len(sums) > PAIRS:
                    yield out()
                    sums.clear()
                row = end

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            last = int(np.flatnonzero(_changes(table))[-1]) if len(table) else 0
            yield from take(table.slice(0, last))
            rest = table.slice(last)
        if rest is not None:
            yield from take(rest)
        yield out()

    parts = spread(entries.sparkSession)
    dealt = entries.select("lang", "term", "source", "p", "p0").repartition(parts, "lang", "term")
    return dealt.sortWithinPartitions("lang", "term").mapInArrow(corrected, "lang string, source string, item string, value long")


def _changes(table: pa.Table) -> np.ndarray:
    """Rows that start a (lang, term)."""
    new = np.ones(len(table), bool)
    if len(table) > 1:
        same = np.ones(len(table) - 1, bool)
        for name in ("lang", "term"):
            column = table[name].combine_chunks()
            same &= np.asarray(pc.equal(column.slice(1), column.slice(0, len(table) - 1)))
        new[1:] = ~same
    return new


def divergence(docs: DataFrame, least_docs: int = 3, top: int = 200, memory: int = MEMORY) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): how a source's term shares differ from others of its language.

    Part ``pair``: for each other source the summed divergence over all kept terms. Part ``term``: the ``top`` terms that the
    source has more often than its language. Ranks fall with the value, equal values by item. Null text, language and source
    count as empty; repeated rows count as often as they are there; a source without terms has its pairs. Further
    columns are not read. An empty table gives no rows.
    """
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], "text")
    terms = frequencies(named, least_docs, memory=memory)
    per_group = terms.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    per_lang = terms.where("lead").groupBy("lang").agg(F.sum("lang_n").alias("lang_n"), F.count(F.lit(1)).alias("v"))
    groups = named.select("lang", "source").distinct().join(per_group, ["lang", "source"], "left").join(per_lang, "lang", "left")
    groups = stored(groups.fillna(0).withColumn("p0", _share(F.lit(0), F.col("n") + F.col("v"))), "groups")

    known = groups.select("lang", "source", F.col("n").alias("all"), F.col("lang_n").alias("lang_all"), "v", "p0")
    entries = terms.join(known, ["lang", "source"]).select(
        "lang", "source", "term", "p0",
        _share(F.col("n"), F.col("all") + F.col("v")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_all") + F.col("v")).alias("q"),
    )
    entries = stored(entries, "entries")
    p, q, p0 = F.col("p"), F.col("q"), F.col("p0")
    excess = entries.where(p > q).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _distance(p, q).alias("value"))

    other = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("o0"))
    o0, apart = F.col("o0"), F.col("source") != F.col("other")
    base = groups.join(other, "lang").where(apart).select("lang", "source", F.col("other").alias("item"), (F.col("v") * _distance(p0, o0)).alias("value"))
    equal = entries.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("h")).join(other, "lang").where(apart)
    forth = equal.select("lang", "source", F.col("other").alias("item"), (F.col("h") * (_distance(p, o0) - _distance(p0, o0))).alias("value"))
    back = equal.select(
        "lang", F.col("other").alias("source"), F.col("source").alias("item"), (F.col("h") * (_distance(o0, p) - _distance(o0, p0))).alias("value")
    )
    every = base.unionByName(forth).unionByName(back).unionByName(_both(entries))
    pairs = every.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    ranked = excess.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ranked)
