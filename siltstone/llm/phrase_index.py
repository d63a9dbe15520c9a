"""Benchmark decontamination by a positional inverted index of the training texts.

The index is sharded by documents: a block holds whole texts laid end to end, and for each of its terms the ascending
places of that term, packed. Blocks are bounded, so the list of a very frequent term is cut into bounded
pieces. The index is a table in the shared folder that any later search reads again.

A search takes phrases. Their terms are counted in the index; a block is a candidate for a phrase if it holds the
phrase's two rarest terms, which needs no places. The candidates of a block then meet the places of the terms they
need, and the lists, adjusted by the offset of each term in the phrase, are intersected from the rarest on. With
``slop`` a term may stand that many words away from its place in the phrase (proximity); without, matches
are exact phrases. Documents are ``GAP`` places apart, so no match crosses from one into the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from siltstone.llm.kernels import slices, text_bytes
from siltstone.llm.lexicon import LETTERS_AND_DIGITS, coded_terms, packed, unpacked
from siltstone.session import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = 64
BLOCK = 1 << 22  # bytes of text in a block, unless one text is longer
CELL = 1 << 14  # phrases that meet a block at a time
POSTINGS, BOUNDS, DOCUMENT = 0, 1, 2


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """A positional index of ``docs``, written to the shared folder.

    Rows of three kinds: the places of a term in a block (``term``, ``n``, ``places``), the first place of each document
    of a block (``places``), and a document (``ord`` within its block, its key in ``id``, its number of words ``n``). Every
    row of ``docs`` is a document of its own, whatever its key; a null text has no words.
    """
    kind = docs.schema[key].dataType
    schema = StructType.fromDDL("kind int, block long, ord int, term string, n long, places binary").add("id", kind)
    fields = pa.schema([
        ("kind", pa.int32()), ("block", pa.int64()), ("ord", pa.int32()), ("term", pa.string()), ("n", pa.int64()),
        ("places", pa.binary()), ("id", to_arrow_type(kind)),
    ])

    def rows(kind: int, number: int, size: int, **columns: object) -> pa.RecordBatch:
        held = {"kind": np.full(size, kind, np.int32), "block": np.full(size, number), **columns}
        arrays = [pa.array(held[f.name], f.type) if f.name in held else pa.nulls(size, f.type) for f in fields]
        return pa.RecordBatch.from_arrays(arrays, schema=fields)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for first, last in slices(bounds, block):
                start, end = bounds[first], bounds[last]
                terms, codes, words = coded_terms(data[start:end], bounds[first : last + 1] - start, LETTERS_AND_DIGITS)
                doc = np.repeat(np.arange(last - first), np.diff(words))
                places = np.arange(len(codes)) + GAP * doc
                firsts = words[:-1] + GAP * np.arange(last - first)
                yield rows(
                    DOCUMENT, number, last - first, ord=np.arange(last - first, dtype=np.int32), n=np.diff(words),
                    id=batch.column(0).slice(first, last - first).cast(fields.field("id").type),
                )
                yield rows(BOUNDS, number, 1, places=[packed(firsts, np.array([0, len(firsts)]))[0].tobytes()])
                if len(codes):
                    counts = np.bincount(codes, minlength=len(terms))
                    lists = np.concatenate([[0], np.cumsum(counts)])
                    raw, offsets = packed(places[np.argsort(codes, kind="stable")], lists)
                    lists = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)]
                    held = pa.Array.from_buffers(pa.binary(), len(terms), lists)
                    yield rows(POSTINGS, number, len(terms), term=terms.cast(pa.string()), n=counts, places=held)
                number += 1

    return stored(docs.select(F.col(key).alias("id"), text).mapInArrow(blocks, schema), "index")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), 0)


def phrases(items: DataFrame, key: str = "item_id", text: str = "text", width: int = 10) -> tuple[DataFrame, DataFrame]:
    """Distinct windows of ``width`` consecutive words, or whole shorter texts: (phrase, terms), and whose they are.

    The second frame has rows (phrase, item). Texts without words have none. Both are written to the shared folder.
    """
    rows = stored(items.select(F.col(key).alias("item"), words(F.col(text)).alias("words")), "items")
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    one = rows.select("item", "row", F.size("words").alias("size"), F.posexplode("words").alias("pos", "word"))
    ahead = Window.partitionBy("row").orderBy("pos").rowsBetween(0, width - 1)
    cut = one.withColumn("terms", F.collect_list("word").over(ahead))
    cut = cut.where((F.size("terms") == width) | (F.col("pos") == 0)).select("item", "terms")
    owned = stored(cut.distinct(), "windows")
    named = stored(owned.select("terms").distinct(), "phrases").withColumn("phrase", F.monotonically_increasing_id())
    return named, stored(owned.join(named, "terms").select("phrase", "item"), "owners")


def _near(places: np.ndarray, wanted: np.ndarray, slop: int) -> np.ndarray:
    """Which wanted places have a place within ``slop``."""
    at = np.searchsorted(places, wanted - slop)
    held = at < len(places)
    held[held] = places[at[held]] <= wanted[held] + slop
    return held


def _anchors(lists: list[np.ndarray], slop: int) -> np.ndarray:
    """Starts of the phrase whose terms, in order, have these places."""
    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    start = lists[order[0]] - order[0]
    for k in order[1:]:
        start = start[_near(lists[k], start + k, slop)]
        if not len(start):
            break
    return start


def find(index: DataFrame, named: DataFrame, slop: int = 0) -> DataFrame:
    """Matches of ``named`` (phrase, terms) in the index: rows (block, ord, runs, found) of documents with one.

    ``runs`` are the united spans (first, last) of words that matches cover, counted from the document's first word;
    ``found`` the phrases. A document can have several rows, for different phrases. A match with ``slop`` covers the phrase's
    length from where its rarest term says that it starts. Phrases of up to ``GAP`` words, with twice the slop, can be sought.
    """
    longest = named.agg(F.max(F.size("terms"))).first()[0] or 0
    if longest + 2 * slop > GAP:
        raise ValueError(f"phrases and slop reach further than {GAP} words")
    slots = named.select("phrase", F.size("terms").alias("size"), F.posexplode("terms").alias("pos", "term"))
    vocabulary = stored(slots.select("term").distinct(), "vocabulary")
    # What the phrases do not use stays where it is; the rest is all that is looked at from here on.
    used = index.where(F.col("kind") == POSTINGS).join(vocabulary, "term", "left_semi")
    postings = stored(used.select("block", "term", "n", "places"), "postings")
    counted = postings.groupBy("term").agg(F.sum("n").alias("total"))
    ranked = slots.select("phrase", "size", "term").distinct().join(stored(counted, "totals"), "term")
    terms = F.sort_array(F.collect_list(F.struct("total", "term")))
    rare = ranked.groupBy("phrase").agg(terms.alias("rare"), F.count(F.lit(1)).alias("n"))
    whole = named.select("phrase", F.size(F.array_distinct("terms")).alias("kinds"))
    rare = rare.join(whole, "phrase").where("n = kinds")  # a phrase with a term that no text has is nowhere
    rare = stored(rare.select(
        "phrase", F.col("rare")[0]["term"].alias("rarest"),
        F.when(F.size("rare") > 1, F.get("rare", F.lit(1))["term"]).otherwise(F.col("rare")[0]["term"]).alias("second"),
    ), "rare")

    held = postings.select("block", "term")
    first = held.join(rare, held["term"] == rare["rarest"]).drop("term", "rarest")
    both = first.join(held, (first["second"] == held["term"]) & (first["block"] == held["block"]), "left_semi")
    cell = F.shiftright("phrase", 33) * (1 << 33 >> 14) + F.expr(f"phrase % {1 << 33} div {CELL}")
    pairs = stored(both.join(named, "phrase").select("block", cell.alias("cell"), "phrase", "terms"), "pairs")
    needed = pairs.select("block", "cell", F.explode("terms").alias("term")).distinct()
    lists = postings.select("block", "term", "places").join(needed, ["block", "term"])
    bounds = index.where(F.col("kind") == BOUNDS).select("block", "term", "places")
    lists = lists.unionByName(bounds.join(pairs.select("block", "cell").distinct(), "block"))

    def matches(wanted: pa.Table, known: pa.Table) -> pa.Table:
        places = dict(zip(known["term"].to_pylist(), known["places"], strict=True))
        firsts = unpacked(places.pop(None).as_py()) if None in places else np.zeros(1, np.int64)
        opened: dict[str, np.ndarray] = {}

        def opening(term: str) -> np.ndarray:
            if term not in opened:
                opened[term] = unpacked(places[term].as_py()) if term in places else np.zeros(0, np.int64)
            return opened[term]

        at, size, name = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for phrase, terms in zip(wanted["phrase"].to_pylist(), wanted["terms"].to_pylist(), strict=True):
            start = _anchors([opening(t) for t in terms], slop)
            at.append(start)
            size.append(np.full(len(start), len(terms)))
            name.append(np.full(len(start), phrase))
        at, size, name = np.concatenate(at), np.concatenate(size), np.concatenate(name)
        doc = np.searchsorted(firsts, at + size // 2 if slop else at, "right") - 1
        block = wanted["block"][0].as_py() if len(wanted) else 0
        docs, runs, found = np.unique(doc), [], []
        order = np.lexsort((at, doc))
        at, size, name, doc = at[order], size[order], name[order], doc[order]
        for d, low, high in zip(docs, np.searchsorted(doc, docs), np.searchsorted(doc, docs, "right"), strict=True):
            start, end = at[low:high], np.maximum.accumulate(at[low:high] + size[low:high])
            new = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
            last = np.concatenate([new[1:], [high - low]]) - 1
            runs.append(
                [{"first": int(a), "last": int(b)} for a, b in zip(start[new] - firsts[d], end[last] - firsts[d], strict=True)]
            )
            found.append(np.unique(name[low:high]).tolist())
        columns = {"block": np.full(len(docs), block), "ord": docs.astype(np.int32), "runs": runs, "found": found}
        return pa.table({f.name: pa.array(columns[f.name], f.type) for f in fields}, fields)

    fields = pa.schema([
        ("block", pa.int64()), ("ord", pa.int32()),
        ("runs", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), ("found", pa.list_(pa.int64())),
    ])
    schema = "block long, ord int, runs array<struct<first:long,last:long>>, found array<long>"
    cells = pairs.groupBy("block", "cell").cogroup(lists.toDF(*lists.columns).groupBy("block", "cell"))
    return stored(cells.applyInArrow(matches, schema), "matches")


def _covered(runs: Column, size: Column) -> Column:
    """Words of a document of ``size`` words that lie in one of the spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))

    def step(acc: Column, run: Column) -> Column:
        low, high = F.greatest(run["first"], acc["upto"]), F.least(run["last"], size)
        return F.struct(
            (acc["n"] + F.greatest(high - low, F.lit(0).cast("long"))).alias("n"), F.greatest(acc["upto"], high).alias("upto")
        )

    return F.aggregate(F.sort_array(runs), start, step, lambda acc: acc["n"])


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", width: int = 10, slop: int = 0
) -> DataFrame:
    """Per row of ``docs`` its key, ``n_words``, ``n_hit`` (words inside a phrase of an item), and ``items`` found in it.

    ``items`` are the distinct ids as text in ascending order; an item without an id hits but is not listed, rows with the same id
    are one item. Null and empty texts have no words and no hits; every row of ``docs`` gives one row, repeated or not.
    Further columns are left out. Without items nothing is hit.
    """
    index = build_index(docs, key)
    named, owners = phrases(items, item, width=width)
    found = find(index, named, slop)
    listed = found.select("block", "ord", F.explode("found").alias("phrase")).join(owners, "phrase")
    listed = listed.select("block", "ord", F.col("item").cast("string").alias("item")).distinct()
    listed = listed.groupBy("block", "ord").agg(F.sort_array(F.collect_list("item")).alias("items"))
    spans = found.groupBy("block", "ord").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    hits = stored(spans.join(listed, ["block", "ord"], "left"), "hits")
    rows = index.where(F.col("kind") == DOCUMENT).select("block", "ord", F.col("id").alias("doc_"), F.col("n").alias("n_words"))
    none = F.array().cast("array<string>")
    return rows.join(hits, ["block", "ord"], "left").select(
        F.col("doc_").alias(key), "n_words",
        F.coalesce(_covered(F.col("runs"), F.col("n_words")), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
    )
