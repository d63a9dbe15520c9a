"""Quality rules over whole texts: base counts and repetition measured by suffix arrays of words.

Each document's words get a suffix array by prefix doubling. The longest common prefix of
neighbours gives, for every position, the longest word string that starts there and occurs
again in the text; these are the maximal repeated strings of the LCP intervals. Their
united spans give the repeated fraction, their longest the longest repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.kernels import Rolling, is_space, slices, text_bytes, word_spans

SLICE = 1 << 19
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat"
)


@dataclass(frozen=True)
class Rules:
    """A document fails with fewer than ``least_words`` words, with more than ``repeat_percent`` of them in
    repeated windows of ``window`` words, with more than ``covered_percent`` in repeated strings of at
    least ``long_repeat`` words, or with a repeated string longer than ``longest_percent`` of the text."""

    least_words: int = 50
    window: int = 3
    repeat_percent: int = 50
    long_repeat: int = 10
    covered_percent: int = 40
    longest_percent: int = 30


def suffix_order(names: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of sequences laid end to end, and the ranks after each doubling.

    ``names``: integers that differ between sequences; ``room``: items from a position to its sequence's end.
    Only groups that are still tied are sorted again.
    """
    size = len(names)
    order = np.argsort(names, kind="stable")
    ranks = np.empty(size, np.int64)
    new = np.ones(size, bool)
    new[1:] = names[order][1:] != names[order][:-1]
    ranks[order] = np.flatnonzero(new)[np.cumsum(new) - 1] if size else 0
    levels, step = [ranks], 1
    while True:
        tied = np.flatnonzero(np.bincount(ranks, minlength=size)[ranks] > 1) if size else order[:0]
        if not len(tied):
            break
        after = np.where(room[tied] > step, ranks[np.minimum(tied + step, size - 1)], -1)
        sort = np.lexsort((after, ranks[tied]))
        tied, after = tied[sort], after[sort]
        group = ranks[tied]
        fresh, new = np.ones(len(tied), bool), np.ones(len(tied), bool)
        fresh[1:] = group[1:] != group[:-1]
        new[1:] = fresh[1:] | (after[1:] != after[:-1])
        at = np.arange(len(tied))
        first = at[fresh][np.cumsum(fresh) - 1]
        ranks = ranks.copy()
        ranks[tied] = group + at[new][np.cumsum(new) - 1] - first
        levels.append(ranks)
        step *= 2
    order = np.empty(size, np.int64)
    order[ranks] = np.arange(size)
    return order, levels


def longest_repeats(names: np.ndarray, room: np.ndarray) -> np.ndarray:
    """For each position the longest string from it that also starts elsewhere in its sequence."""
    order, levels = suffix_order(names, room)
    best = np.zeros(len(names), np.int64)
    if len(names) < 2:
        return best
    a, b = order[:-1], order[1:]
    common = np.zeros(len(a), np.int64)
    fits = np.minimum(room[a], room[b])
    for level in range(len(levels) - 1, -1, -1):
        step, ranks = 1 << level, levels[level]
        open_ = np.flatnonzero(common + step <= fits)
        same = open_[ranks[a[open_] + common[open_]] == ranks[b[open_] + common[open_]]]
        common[same] += step
    np.maximum.at(best, a, common)
    np.maximum.at(best, b, common)
    return best


def _covered(repeats: np.ndarray, least: int, first: np.ndarray) -> np.ndarray:
    """Positions per sequence that lie in repeated strings of at least ``least`` items."""
    edge = np.zeros(len(repeats) + 1, np.int64)
    start = np.flatnonzero(repeats >= least)
    edge[start] += 1
    np.subtract.at(edge, start + repeats[start], 1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(edge)[:-1] > 0)])
    return inside[first[1:]] - inside[first[:-1]]


def _per_doc(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _dup_lines(text: bytes) -> int:
    seen, count = set(), 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\n\x0b\x0c\r"):
            count += line in seen
            seen.add(line)
    return count


def measures(data: np.ndarray, bounds: np.ndarray, rules: Rules) -> list[np.ndarray]:
    """The counts named in COUNTS, for each document."""
    starts, ends, first = word_spans(data, bounds)
    words = np.diff(first)
    space = is_space(data)
    chars = _per_doc(~space & ((data & 0xC0) != 0x80), bounds)
    symbol = np.zeros(256, bool)
    symbol[SYMBOLS] = True
    doc = np.repeat(np.arange(len(words)), words)
    order = np.lexsort((hashes := Rolling(data).spans(starts, ends), doc))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(new)
    room = first[1:][doc] - np.arange(len(doc))
    repeats = longest_repeats(names, room)
    longest = np.zeros(len(words), np.int64)
    np.maximum.at(longest, doc, repeats)
    lines = [_dup_lines(data[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return [
        words, chars, _per_doc(symbol[data], bounds), np.array(lines, np.int64),
        _covered(repeats, rules.window, first), _covered(repeats, rules.long_repeat, first), longest,
    ]


def _measure(rules: Rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            parts = [
                measures(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], rules)
                for i, j in slices(bounds, SLICE)
            ]
            counts = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*parts, strict=True)] or [
                pa.array([], pa.int64())
            ] * len(COUNTS)
            others = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in others), *counts], names=[*others, *COUNTS]
            )

    return run


def quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, kept.

    ``docs`` needs ``doc_id`` and ``text``; further columns are ignored. Words are runs of bytes other than 0x20 and
    0x09-0x0D, compared as they are. Null and empty texts have no words and fail. Rows are
    judged one by one, so repeated rows and ids give equal rows. An empty table gives no rows.
    """
    counted = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _measure(rules), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS)
    )
    return counted.select("*", *_verdict(rules))


def _verdict(rules: Rules) -> list:
    n = F.col("n_words")
    failed = (n < rules.least_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * n)
    return [
        failed.alias("base_failed"),
        (
            ~failed
            & (100 * F.col("n_covered_words") <= rules.covered_percent * n)
            & (100 * F.col("longest_repeat") <= rules.longest_percent * n)
        ).alias("kept"),
    ]


def good_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns, whatever their names. The texts are measured where they are read."""
    kind = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"

    @F.arrow_udf(kind)
    def measured(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text], names=["text"])
        (out,) = _measure(rules)(iter([batch]))
        return pa.StructArray.from_arrays(out.columns, names=list(COUNTS))

    name = "measured"
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    marked = docs.withColumn(name, measured(F.col("text").cast("string")))
    counts = marked.select("*", *(F.col(f"{name}.{c}").alias(f"{name}_{c}") for c in COUNTS))
    n = F.col(f"{name}_n_words")
    ok = (
        (n >= rules.least_words)
        & (100 * F.col(f"{name}_n_repeat_words") <= rules.repeat_percent * n)
        & (100 * F.col(f"{name}_n_covered_words") <= rules.covered_percent * n)
        & (100 * F.col(f"{name}_longest_repeat") <= rules.longest_percent * n)
    )
    return counts.where(ok).select(*[f"`{c}`" for c in docs.columns])
