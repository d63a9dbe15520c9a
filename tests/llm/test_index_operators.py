"""Merkle proofs, phrase search and source divergence against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltstone.llm import divergence as audit
from siltstone.llm import phrase_index, queries
from siltstone.llm.lexicon import LETTERS_AND_DIGITS, coded_terms, packed, unpacked
from siltstone.llm.merkle import fold, manifest, proofs, verified

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


# Terms and lists


def test_packed_lists_come_back():
    draw = np.random.default_rng(4)
    lists = [np.sort(draw.integers(0, top, size)) for top, size in ((5, 3), (1 << 40, 50), (1, 1), (1 << 20, 4000))]
    firsts = np.cumsum([0, *map(len, lists)])
    raw, bounds = packed(np.concatenate(lists), firsts)
    for k, values in enumerate(lists):
        assert unpacked(raw[bounds[k] : bounds[k + 1]].tobytes()).tolist() == values.tolist()
    assert unpacked(b"").tolist() == []


def test_terms_end_at_texts():
    texts = ["Ab cd", "", "CD-é9", "ab"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0, *(len(t.encode()) for t in texts)])
    terms, codes, first = coded_terms(data, bounds, LETTERS_AND_DIGITS)
    assert [terms[int(c)].as_py() for c in codes] == ["ab", "cd", "cd", "é9", "ab"]
    assert first.tolist() == [0, 2, 2, 4, 5]


# Merkle proofs


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(row):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def grown(nodes):
    """The root, and for each node its siblings as (left, right) by level."""
    ways, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i - i % 3 : i - i % 3 + 3]
            ways[k].append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
        level = [sha(*level[i : i + 3]) for i in range(0, len(level), 3)]
        at = [i // 3 for i in at]
    return level[0], ways


def proven(rows):
    """Sorted (doc_id, leaf, subroot, root, siblings)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row["source"]].append((row["doc_id"] is not None, row["doc_id"], leaf_of(row)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    below = [grown([leaf for *_, leaf in sorted(groups[s], key=lambda x: (x[0], x[1] or 0, x[2]))]) for s in order]
    root, above = grown([subroot for subroot, _ in below])
    out = []
    for s, (subroot, ways), more in zip(order, below, above, strict=True):
        for (_, doc, leaf), way in zip(sorted(groups[s], key=lambda x: (x[0], x[1] or 0, x[2])), ways, strict=True):
            out.append((doc, leaf, subroot, root, tuple(way + more)))
    return sorted(out, key=repr)


def sources(spark, sizes, repeats=0):
    draw, rows = random.Random(7), []
    for source, size in sizes:
        for _ in range(size):
            text = draw.choice([None, "", "a\nb\n", "é" * 40, "x " * draw.randrange(2000)])
            rows.append((len(rows) if draw.random() > 0.02 else None, source, draw.choice([None, "en", ""]), None if text is None else len(text), text, 1, 2))
    rows += rows[:repeats]
    draw.shuffle(rows)
    ddl = "doc_id long, source string, lang string, n_chars long, text string, tree int, level int"
    return spark.createDataFrame(rows, ddl), [dict(zip(ddl.replace(" long", "").replace(" string", "").replace(" int", "").split(", "), r, strict=True)) for r in rows]


@pytest.mark.parametrize(
    "sizes", [[("a", 1)], [(None, 81)], [("a", 1), (None, 2), ("", 3), ("é", 4), ("b", 100), ("z", 243), ("y", 10)], [(str(k), 1) for k in range(30)], [("a", 6600), ("b", 2), ("c", 90)]]
)
def test_proofs(spark, sizes):
    docs, rows = sources(spark, sizes, repeats=sum(n for _, n in sizes) // 10)
    got = manifest(docs).collect()
    assert sorted(
        ((r.doc_id, r.leaf, r.subroot, r.root, tuple((bytes(s.left).hex(), bytes(s.right).hex()) for s in r.segments)) for r in got), key=repr
    ) == proven(rows)


def test_proofs_tell_what_was_changed(spark):
    docs, rows = sources(spark, [("a", 50), ("b", 7)])
    held = manifest(docs)
    same = verified(held, "leaf").select("verified").distinct().collect()
    assert [r.verified for r in same] == [True]
    other = held.select(fold(F.sha2("leaf", 256), F.col("segments")).alias("folded"), "root")
    assert other.where("folded = root").isEmpty()
    named = held.select("doc_id", "source", F.col("leaf").alias("row"), F.lit(1).alias("segments"), F.lit(2).alias("idx"))
    assert proofs(named, "source", "doc_id", "row").columns == ["doc_id", "source", "row", "idx", "subroot", "root", "segments"]


def test_manifest_of_an_empty_table(spark):
    docs, _ = sources(spark, [("a", 2)])
    assert manifest(docs.where("false")).collect() == []


# Phrases


def found_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def phrase_hits(docs, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        w = found_words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[i : i + width])].add(item)
    out = []
    for doc, text in docs:
        w, hit, ids = found_words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if owners := windows.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    ids.update(str(o) for o in owners if o is not None)
        out.append((doc, len(w), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def benchmark_like():
    draw = random.Random(5)
    words = lambda n: [f"{draw.choice('abcde')}{draw.randrange(30)}" for _ in range(n)]
    items = [(k, " ".join(words(draw.choice([3, 9, 10, 11, 40])))) for k in range(25)]
    items += [(100, None), (101, ""), (102, " -- "), (103, "the"), (104, "THE the"), (None, "q1 q2 q3"), (7, items[3][1]), (11, items[7][1])]
    docs = []
    for k in range(120):
        parts = words(draw.choice([0, 5, 60, 300]))
        for _ in range(draw.randrange(3)):
            _, text = draw.choice(items)
            piece = (text or "").split()
            cut = piece[: draw.choice([len(piece), 10, 9])]
            at = draw.randrange(len(parts) + 1)
            parts[at:at] = [w.upper() for w in cut]
        docs.append((k, ", ".join(parts)))
    long = " ".join(words(20_000) + items[4][1].split() + words(5))
    docs += [(200, None), (201, ""), (202, "The"), (203, "the, the"), (None, long), (5, long), (5, "q1 q2 q3"), (6, "q1 q2"), (6, "q3 é")]
    docs += [(300 + k, items[9][1]) for k in range(60)]
    return docs, items


@pytest.mark.parametrize("block,cell", [(phrase_index.BLOCK, phrase_index.CELL), (600, 7)])
def test_contamination(spark, monkeypatch, block, cell):
    docs, items = benchmark_like()
    built = phrase_index.build_index
    monkeypatch.setattr(phrase_index, "build_index", lambda docs, key: built(docs, key, block=block))
    monkeypatch.setattr(phrase_index, "CELL", cell)
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, block int, term string")
    tests = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, phrase int")
    got = phrase_index.contamination(frame, tests).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got), key=repr) == phrase_hits(docs, items)


def test_contamination_by_text_ids_and_without_items(spark):
    docs = spark.createDataFrame([("a", "one two three"), ("b", None)], "doc_id string, text string")
    items = spark.createDataFrame([("i", "two three")], "item_id string, text string")
    got = phrase_index.contamination(docs, items).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got) == [("a", 3, 2, ["i"]), ("b", 0, 0, [])]
    none = phrase_index.contamination(docs, items.where("false")).collect()
    assert sorted((r.doc_id, r.n_hit) for r in none) == [("a", 0), ("b", 0)]
    assert phrase_index.contamination(docs.where("false"), items).collect() == []


def test_proximity(spark):
    texts = ["red green blue", "red x green blue", "red green x x blue", "blue green red", "red", "green blue"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = phrase_index.build_index(docs)
    items = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    named, _ = phrase_index.phrases(items)
    ids = index.where(F.col("kind") == phrase_index.DOCUMENT).select("block", "ord", "id")
    for slop, expected in ((0, [0]), (1, [0, 1]), (2, [0, 1, 2])):
        got = phrase_index.find(index, named, slop).join(ids, ["block", "ord"]).select("id").collect()
        # Which order the last text is found in depends on the rarest word, from which places are counted.
        assert sorted(r.id for r in got if r.id != 3) == expected
    with pytest.raises(ValueError, match="reach"):
        phrase_index.find(index, named, 40)


# Divergence


def diverged(rows, least=3, top=200):
    docs = [((lang or ""), (source or ""), Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER)))) for lang, source, text in rows]
    langs, out = defaultdict(set), []
    for lang, source, _ in docs:
        langs[lang].add(source)
    for lang, names in langs.items():
        mine = [(s, c) for k, s, c in docs if k == lang]
        seen = Counter(t for _, c in mine for t in c)
        kept = sorted(t for t, n in seen.items() if n >= least)
        of = {s: Counter() for s in names}
        for s, c in mine:
            of[s].update({t: c[t] for t in kept})
        whole = sum(of.values(), Counter())

        def shares(count, kept=kept):
            total = sum(count.values()) + len(kept)
            return {t: 1 + int(Fraction(10**9 * (count[t] + 1), total)) for t in kept}

        p, q = {s: shares(of[s]) for s in names}, shares(whole)
        for s in names:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in names if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if of[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (-x[0], x[1].encode()))[:top])):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(out)


def prose(seed, count):
    draw, rows = random.Random(seed), []
    for _ in range(count):
        lang, source = draw.choice(["en", "en", "de", None]), draw.choice(["a", "a", "b", "c", None, "é"])
        skew = draw.choice([3, 9, 25])
        rows.append((lang, source, " ".join(draw.choice(["wort", "Wort", "ééé", "x"]) + "abcdefghijklmnopqrstuvwxyz"[int(draw.random() * skew)] for _ in range(draw.randrange(80)))))
    return rows + [("fr", "only", None), ("it", "a", "uno"), ("it", "b", "due"), ("it", "c", None), ("en", "empty", ""), ("en", "a", "wort " * 3000)] + rows[:5]


@pytest.mark.parametrize("memory,top", [(audit.MEMORY, 200), (4000, 3)])
def test_divergence(spark, memory, top):
    rows = prose(2, 150)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, rank int, value string")
    got = audit.divergence(docs.repartition(5), top=top, memory=memory).collect()
    assert sorted(tuple(r) for r in got) == diverged(rows, top=top)


def test_runs_spill_and_merge(spark, monkeypatch):
    rows = prose(3, 90)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    monkeypatch.setattr(audit, "PIECE", 4)
    monkeypatch.setattr(audit, "SLICE", 300)
    pieces = audit.runs(docs, 2, memory=2000).collect()
    assert len({r.run for r in pieces}) > 3 and max(len(r.term) for r in pieces) <= 4
    for piece in pieces:
        assert piece.term == sorted(piece.term) and piece.first == piece.term[0]
    order = sorted(pieces, key=lambda r: (r.shard, r.first, r.run))
    opened = [(r.shard, r.first, pa.table({c: getattr(r, c) for c in audit.POSTING})) for r in order]
    for least in (1, 50, 10**6):
        parts = list(audit.merged(opened, least))
        assert sum(map(len, parts)) == sum(len(r.term) for r in pieces)
        # A term is in one batch only, and batches of a shard ascend.
        spans = [(audit.crc32(p["term"][0].as_py().encode()) % 2, min(p["term"].to_pylist()), max(p["term"].to_pylist())) for p in parts]
        assert all(a[0] < b[0] or a[0] == b[0] and a[2] < b[1] for a, b in zip(spans, spans[1:]))
    assert len(parts) == 2 and len(list(audit.merged(opened, 1))) > 10


def test_corrections_of_many_pairs_at_a_time(spark, monkeypatch):
    rows = prose(4, 60)
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    monkeypatch.setattr(audit, "PAIRS", 3)
    assert sorted(tuple(r) for r in audit.divergence(docs).collect()) == diverged(rows)


def test_divergence_of_an_empty_table(spark):
    assert audit.divergence(spark.createDataFrame([], "lang string, source string, text string")).collect() == []


def test_given_tables_hold_benchmark_passages(spark):
    hits = queries.QUERIES["op12_phrase_index"](spark, SMALL).where("contaminated").collect()
    assert hits and all(r.n_hit <= r.n_words and r.n_items for r in hits)
