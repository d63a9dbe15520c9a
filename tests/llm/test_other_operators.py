"""Vectors, licences, packing, mixing, chats and archives against brute force and round trips."""

from __future__ import annotations

import hashlib
import math
import textwrap
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltstone.llm import licenses, queries
from siltstone.llm.chat_tree import Chat, escape, format_chats, parsed, read_chats, unescape
from siltstone.llm.embedding_dedup import similar_vectors
from siltstone.llm.mixing import mix_sources
from siltstone.llm.packing import Packing, combinations, nnls, pack, plan, sequences
from siltstone.llm.tokens import encoder, word_bpe_path
from siltstone.llm.warc import archived_pages, page_records, read_archives, register, write_archives
from siltstone.session import fresh_dir

SMALL = "/root/testdata/sf0.001"


# Vectors


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, e, label, i, "x") for i, e, label in rows],
        "vec_id long, embedding array<float>, label int, rep long, packed string",
    )


def linked(rows, least=0.93):
    ok = {}
    for k, (i, e, label) in enumerate(rows):
        if i is None or label is None or not e or None in e:
            continue
        x = np.array(e, np.float32).astype(np.float64)
        if np.isfinite(x).all() and (x != 0).any():
            ok[k] = (label, x / np.sqrt(x @ x))
    links = defaultdict(set)
    for a in ok:
        for b in ok:
            if a != b and ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1]) and ok[a][1] @ ok[b][1] >= least:
                links[a].add(b)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        out.append((i, len(links[k]), min(rows[b][0] for b in seen) if i is not None else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("tile", [3, 1024])
def test_vectors(spark, tile):
    draw = np.random.default_rng(3)
    rows = []
    for k in range(120):
        base = draw.normal(size=24) if k % 4 == 0 else np.array(rows[-1][1]) + draw.normal(size=24) * 0.12
        rows.append((k, [float(v) for v in base], int(k // 40)))
    rows += [(200 + k, rows[5][1], 0) for k in range(7)] + [(5, rows[5][1], 0)]
    rows += [
        (300, None, 0), (301, [], 0), (302, [0.0] * 24, 0), (303, [1.0, None], 0), (304, [float("nan")] * 24, 0),
        (305, [float("inf")] * 24, 0), (306, rows[5][1], None), (307, rows[5][1], 2), (308, [1.0], 0), (309, [2.0], 0),
        (None, rows[5][1], 0), (310, [v * 3 for v in rows[5][1]], 0),
    ]
    got = similar_vectors(vectors(spark, rows), tile=tile).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == linked(rows)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)


def test_vectors_of_tiny_and_huge_numbers(spark):
    """Their squares leave the range of doubles, their directions do not."""
    base = [1.0, 2.0, -1.5, 0.25]
    rows = [(k, [v * s for v in base], 0) for k, s in enumerate((1e-200, 1.0, 1e200, 1e-320, -1e200))] + [(9, [1e308, -1e308, 1e308, 1e-308], 0)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in similar_vectors(docs).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 3: (3, 0), 4: (0, 4), 9: (0, 9)}


def test_vectors_of_an_empty_table_and_of_the_given_one(spark):
    assert similar_vectors(vectors(spark, [])).count() == 0
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = queries.op1_pca_tiles(spark, SMALL).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == linked(rows)


# Licences


def test_licences(spark):
    text = "Nothing here.\nReleased under the MIT License.\n\nlicensed under the apache license, version 2.0.\nThe licence of poets."
    rows = [(1, text), (1, text), (2, None), (3, ""), (4, "lorem ipsum\n" * 300 + "Licensed under CC BY-NC 4.0."), (5, "word " * 50_000)]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, line long, family string")
    got = sorted((r.doc_id, r.line, r.family) for r in licenses.scan_licences(docs).collect())
    assert got == sorted([(1, 1, "MIT"), (1, 3, "Apache")] * 2 + [(4, 300, "CC-BY-NC")])
    assert licenses.scan_licences(docs.limit(0)).count() == 0


def test_licence_classifier_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = licenses.fit(licenses.corpus_sample(docs, licenses.Licences()), licenses.Licences())
    assert model.held_out_accuracy >= 0.97 and 0.1 <= model.temperature <= 10


def test_licences_of_the_table(spark):
    want = {
        (r.doc_id, k)
        for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()
        for k, x in enumerate(r.text.split("\n"))
        if "License" in x or "Licensed under CC" in x
    }
    assert {(r.doc_id, r.line) for r in queries.op2_license_scan(spark, SMALL).collect()} == want


def test_wrapped_and_embedded_licences(spark):
    grant = " ".join(licenses.PARAGRAPHS["MIT"][0].split())
    wrapped = lambda x, mark="": textwrap.fill(x, 78, initial_indent=mark, subsequent_indent=mark)
    whole = {
        f: f"{licenses.TITLES[f][-1]}\n\nCopyright (c) 2020 Ann Author\n\n" + "\n\n".join(map(wrapped, licenses.PARAGRAPHS[f]))
        for f in ("MIT", "BSD", "ISC", "GPL", "LGPL", "AGPL", "Apache", "MPL")
    }
    prose = " ".join(f"word{k % 97} of a story{k % 89}" for k in range(150))
    rows = [(f, text) for f, text in whole.items()]
    rows += [
        ("lines", "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated documentation files, to deal\nin the Software without restriction."),
        ("clause", wrapped(licenses.TEMPLATES["BSD"][0]).replace("\n", "\r\n")),
        ("comment", "int a;\n" + wrapped(licenses.PARAGRAPHS["Apache"][0], " * ") + "\n *\n" + wrapped(licenses.PARAGRAPHS["Apache"][1], " * ")),
        ("embedded", f"{prose} {grant} {prose} Released under the ISC License. {prose}"),
        ("spdx", "// SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause)\nx = 1\n/* SPDX-License-Identifier:MIT */"),
        ("none", f"{prose}\nThe MIT licence list\nPermission is hereby\n\ngranted, free of charge,\n\nto any person\n{prose}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = defaultdict(list)
    for r in licenses.scan_licences(docs).collect():
        got[r.doc_id].append((r.line, r.family))
    for family, text in whole.items():
        starts = [k for k, x in enumerate(text.split("\n")) if k != 2 and x and (k == 0 or not text.split("\n")[k - 1])]
        assert sorted(got[family]) == [(k, family) for k in starts], family
    assert got["lines"] == [(0, "MIT")] and got["clause"] == [(0, "BSD")]
    apache = 1 + len(wrapped(licenses.PARAGRAPHS["Apache"][0], " * ").split("\n")) + 1
    assert sorted(got["comment"]) == [(1, "Apache"), (apache, "Apache")]
    assert sorted(got["embedded"]) == [(0, "ISC"), (0, "MIT")]
    assert sorted(got["spdx"]) == [(0, "BSD"), (0, "GPL"), (2, "MIT")]
    assert got["none"] == []


# Packing


def test_tokens_equal_the_tokenizer():
    encode, texts = encoder(word_bpe_path()), [
        "", None, "  ", "Hello, World. It's they'll don't.", "x<|endoftext|>y z.", "<|ENDOFTEXT|> q", "é.É,ß ÀÿŸ K ſt",
        "a.b,c\x0bd\x85e f g", "é. á,", "ΑΣ. ΣΑΣ", "a\x1cb\x1fc", "İstanbul 12.5,3 a1.b2", "'s't a's. o'clock,", "中文。字, ab中.c", "w " * 5000,
    ]
    ids, bounds = encode(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == encode.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_plan_uses_every_piece_once():
    draw, p = np.random.default_rng(1), Packing(window=64)
    for size in (0, 1, 50, 5000):
        have = np.bincount(draw.integers(1, 65, size), minlength=65)
        used = Counter()
        for pattern, times in plan(have, p):
            assert sum(pattern) <= 64 and times > 0
            for n in pattern:
                used[n] += times
        assert all(used[n] == have[n] for n in range(65))


def test_nnls_solves_a_known_case():
    have = np.zeros(11, np.int64)
    have[[4, 6, 10, 3]] = [7, 7, 2, 0]
    combos = combinations(have, 10, 3)
    assert combos == [(4, 6), (10,)]
    assert np.allclose(nnls(combos, have, 400), [7, 2], atol=1e-3)


def test_packing_of_odd_rows(spark):
    texts = [None, "", "word " * 9000, "one", "one", "a b c d e f g"] + [f"text {k} " * (k % 90) for k in range(200)]
    rows = [(k // 2 if k < 20 else k, t, 1, 2) for k, t in enumerate(texts)] + [(None, "no id", 1, 2)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, salt long, rank long")
    pieces = pack(docs).collect()
    tokenizer = Tokenizer.from_file(word_bpe_path())
    want = Counter((d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])) for d, t, _, _ in rows)
    found = Counter((p.doc_id, p.start, p.length, p.doc_tokens, bytes(p.ids)) for p in pieces)
    expected = Counter()
    for (d, ids), n in want.items():
        for at in range(0, len(ids), 4096):
            part = ids[at : at + 4096]
            expected[(d, at, len(part), len(ids), np.array(part, "<u4").tobytes())] += n
    assert found == expected
    used = defaultdict(list)
    for p in pieces:
        used[p.sequence_id].append((p.offset, p.length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(used) <= math.ceil(sum(p.length for p in pieces) / 4096) + 1
    whole = sequences(pack(docs)).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(p.length for p in pieces)
    assert pack(docs.limit(0)).count() == 0


# Mixing


def test_mixing_reaches_its_weights(spark):
    rows = [(k, "x" * (50 if k % 3 else 10), None if k % 3 == 2 else f"s{k % 3}") for k in range(6000)]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, source string, copy int")
    got = mix_sources(docs, {"s0": 3.0, "s1": 1.0, None: 1.0}, epochs=2.0)
    assert got.columns == ["doc_id", "text", "source", "copy"]
    size = Counter()
    for r in got.collect():
        size[r.source] += len(r.text)
    total = 2 * sum(len(r[1]) for r in rows)
    assert abs(size["s0"] / total - 0.6) < 0.02 and abs(size["s1"] / total - 0.2) < 0.02
    again = mix_sources(docs, {"s0": 3.0, "s1": 1.0, None: 1.0}, epochs=2.0)
    assert again.exceptAll(got).count() == 0
    assert [r.doc_id for r in got.collect()] != sorted(r.doc_id for r in got.collect())


def test_mixing_with_large_rates_and_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "a", "small"), (1, "a", "small"), (None, "b", "small"), (2, None, "none"), (3, "", "none"), (4, "z" * 4000, "big")],
        "doc_id long, text string, source string",
    )
    count = Counter((r.doc_id, r.source) for r in mix_sources(docs, {"small": 1.0, "none": 1.0}).collect())
    assert set(count) <= {(1, "small"), (None, "small")}
    assert abs(sum(count.values()) - 4003) < 400
    assert mix_sources(docs.limit(0)).count() == 0
    named = docs.withColumns({"source_": F.lit("a"), "ORDER_": F.lit("b"), "draws_": F.lit("c"), "copy": F.lit("d")})
    got = mix_sources(named)
    assert got.columns == ["doc_id", "text", "source", "source_", "ORDER_", "draws_", "copy"]
    assert {(r.source_, r.ORDER_, r.draws_) for r in got.collect()} == {("a", "b", "c")}
    with pytest.raises(ValueError):
        mix_sources(docs, {"small": -1.0})


# Chats


def test_escapes_are_reversible():
    for text in ("", "\\", "\\e", "<|im_start|>", "a<|im_end|>\\</s>[INST] ok [/INST]\\\\n", "<\\e|im_start|>", "<|im_<|im_end|>end|>"):
        escaped = escape(text)
        assert unescape(escaped) == text and "<|im_end|>" not in escaped and "[INST]" not in escaped
        assert parsed(f"<|im_start|>{escape(text, True)}\n{escaped}<|im_end|>\n") == (text, text)


@pytest.mark.parametrize("window", [40, 16_384])
def test_chats(spark, window):
    rows = [(c, t, r, f"shared {t}" if t < 3 else f"own {c} é\n") for c in range(30) for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    rows += [(100 + k, t, r, "hello </s>") for k in range(9) for t, r in enumerate(["user", "assistant"])]
    rows += [(50, 2, "assistant", None), (50, 1, None, "<|im_end|>"), (50, None, "a\nb", "\\n"), (51, 0, "assistant", "x" * 3000)]
    rows += [(52, 0, "user", "same"), (52, 0, "user", "same"), (None, 0, "user", "no id")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, path long")
    chat = Chat(window=window)
    packs = format_chats(turns, chat)
    got = {r.conv_id: r for r in read_chats(packs, chat).collect()}
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(convs)
    for c, own in convs.items():
        own = sorted(own)
        trained = "".join(x for *_, r, x in own if r == "assistant")
        want = hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in own).encode()).hexdigest()
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars) == (len(own), want, len(trained))
        assert got[c].loss_sha256 == hashlib.sha256(trained.encode()).hexdigest()
    for p in packs.collect():
        assert len(p.conversations) == 1 or len(p.ids) <= window
        for t in p.turns:
            above, at = [], t.parent
            while at >= 0:
                above = [*range(p.turns[at].start, p.turns[at].end), *above]
                at = p.turns[at].parent
            assert [i for a in t.ancestors for i in range(a.start, a.end)] == above
            assert p.position_ids[t.start : t.end] == list(range(len(above), len(above) + t.end - t.start))
    if window > 1000:
        assert sum(len(p.turns) for p in packs.collect()) < len(rows) - 40
    assert format_chats(turns.limit(0), chat).count() == 0


# Archives


def page_rows():
    body = "é" * 60
    return [
        (5, "http://a/1", body), (3, "http://b/ü\r\nx", body), (9, None, body), (3, "http://b/3", body), (7, "u", "short"),
        (8, "u", "short"), (1, "u", None), (2, "u", ""), (None, "u", body), (11, "u", "z" * 400_000), (12, "u", "\r\n\r\nWARC/1.1\r\n" * 20),
    ]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, first string, n long")


def test_archived_pages(spark):
    rows, path = page_rows(), fresh_dir(spark, "warc-test")
    write_archives(page_records(pages(spark, rows)), path)
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(i, first.get(data, i))
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = i is not None and first.get(data, i) != i
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[data] if again else None))
    assert sorted((tuple(r) for r in archived_pages(spark, path).collect()), key=repr) == sorted(want, key=repr)


def test_archives_push_predicates_and_skip_payloads(spark):
    path = fresh_dir(spark, "warc-test")
    write_archives(page_records(pages(spark, page_rows())), path)
    hits = read_archives(spark, path).where("record_type = 'revisit' and target_uri = 'http://a/1'")
    assert [r.record_id for r in hits.collect()] == ["urn:page:5"]
    assert read_archives(spark, path, payload=False).where(F.col("payload").isNotNull()).count() == 0
    assert read_archives(spark, path, partitionbytes=1).count() == len(page_rows())
    assert read_archives(spark, path).where("record_id in ('urn:page:7', 'urn:page:8')").count() == 2


def test_archives_of_other_writers(spark, tmp_path):
    """Plain archives, and gzip members without their length."""
    import gzip

    def record(kind, body):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{kind}>\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    records = [record("warcinfo", b"info"), record("response", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + b"q" * 200_000), record("resource", b"raw")]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    register(spark)
    got = [(r.record_type, bytes(r.payload)) for r in read_archives(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted([("warcinfo", b"info"), ("response", b"q" * 200_000), ("resource", b"raw")] * 2)
    skipped = read_archives(spark, str(tmp_path)).where("record_type = 'resource'").collect()
    assert [bytes(r.payload) for r in skipped] == [b"raw"] * 2


def test_archives_of_an_empty_table(spark):
    path = fresh_dir(spark, "warc-test")
    write_archives(page_records(pages(spark, [])), path)
    assert archived_pages(spark, path).count() == 0
