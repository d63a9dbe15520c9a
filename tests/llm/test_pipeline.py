"""The corpus pipeline, stage by stage, against brute force."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from test_text_operators import WORD, deduped_lines, documents, linked, measured, odd_texts
from tokenizers import Tokenizer

import corpus_pipeline
from siltstone.llm.repetition import COUNTS, quality
from siltstone.llm.tokens import word_bpe_path

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def copies(doc_id, rate):
    u = int(hashlib.md5(f"17:0:{doc_id}".encode()).hexdigest()[:13], 16) / 16**13
    count, p = 0, math.exp(-rate)
    upto = p
    while upto <= u:
        count += 1
        p *= rate / count
        upto += p
    return count


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        held.append(docs.collect())
        assert k == 4 or docs.columns == COLUMNS

    start = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    verdict = {r.doc_id: r for r in quality(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()}
    for d, row in start.items():
        want, longest = measured(row.text)
        assert tuple(verdict[d][c] for c in COUNTS[:5]) == want
        assert not longest or verdict[d].longest_repeat == longest
    assert sorted(held[0]) == sorted(r for d, r in start.items() if verdict[d].kept)

    lines = dict(deduped_lines([(r.doc_id, r.text) for r in held[0]], 10))
    left = {d: t for d, t in lines.items() if t == start[d].text or WORD.search(t)}
    assert {r.doc_id: r.text for r in held[1]} == left
    assert all(r.n_chars == len(r.text) for r in held[1] if r.text != start[r.doc_id].text)

    groups = linked([(r.doc_id, r.text) for r in held[1]])
    assert sorted(held[2]) == sorted(r for r in held[1] if groups[r.doc_id][1] == r.doc_id)

    size = Counter()
    for r in held[2]:
        size[r.source] += len(r.text)
    share = sum(size.values()) / sum(n > 0 for n in size.values())
    want = Counter({r.doc_id: n for r in held[2] if size[r.source] and (n := copies(r.doc_id, share / size[r.source]))})
    assert Counter(r.doc_id for r in held[3]) == want

    tokenizer, pieces = Tokenizer.from_file(word_bpe_path()), Counter()
    for r in held[3]:
        ids = tokenizer.encode(r.text, add_special_tokens=False).ids + [2]
        for at in range(0, len(ids), 4096):
            pieces[(r.doc_id, at, np.array(ids[at : at + 4096], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.start, bytes(r.ids)) for r in held[4]) == pieces


def test_pipeline_runs_on_odd_and_empty_tables(spark, tmp_path):
    rows = documents(spark, odd_texts()).selectExpr("doc_id", "text", "'en' lang", "source", "pos n_chars")
    for name, docs in (("odd", rows), ("empty", rows.limit(0))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert (out.count() > 0) == (name == "odd")


def test_stages_give_back_columns_of_any_name(spark):
    names = [
        "copy", "measured_n_words", "measured", "pos_", "removed_lines", "source_", "rate_", "order_", "draws_", "below_", "gone_",
        "text_hash_", "kept_id", "row", "other_columns", "kept", "component_id", "n_words", "a.b", "pos__own",
    ]
    text = " ".join(f"w{k % 61}x{k}" for k in range(80))
    lines = "\n".join(" ".join(f"l{j}k{k}" for k in range(12)) for j in range(12))
    rows = [(1, text, "en", "s", 1), (2, f"{text} more", "en", "s", 2), (3, lines, "de", "t", 3), (4, f"{lines}\nown " + text[::-1], "de", None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for k, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{k}:"), F.col("doc_id").cast("string")))
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        kept = out.collect()
        assert kept and all(r[name] == f"{k}:{r.doc_id}" for r in kept for k, name in enumerate(names))
    assert corpus_pipeline.packing(spark, docs, SMALL).count() >= 4
