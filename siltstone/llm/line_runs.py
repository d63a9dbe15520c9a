"""Removal of repeated line runs by hashes of shortest runs of lines. Native operations only.

This replaces a suffix array over line ids: there are no ranks, no order of suffixes and no common prefixes.

A document is the sequence of the ids of its lines that hold a word. Doubling names every run of 1, 2, 4, ... lines by
a hash of the names of its halves; a run of any length is named by the two overlapping names that cover it. Runs are
grouped by name, and the lines of all members but the first are deleted.

A maximal repeated run counts if it has at least ``least_words`` words. Every line of such a run lies in a shortest
run of that many words that starts or ends at a line, so two runs per line decide exactly which lines go. Shortest
runs have at most ``least_words`` lines, which bounds the doublings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.frames import LAST, sheltered

LEAST_WORDS = 10
WORD = "[^\\x20\\x09-\\x0D]+"


def _position() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))


def line_runs(docs: DataFrame, least_words: int) -> DataFrame:
    """Shortest runs of ``least_words`` words: pos, text_hash, n (number of the first among the lines with words), lines, key."""
    lines = docs.where("text is not null").select(
        _position().alias("pos"), F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n", -1)).alias("line", "x")
    )
    lines = lines.select(
        "pos", "text_hash", "line", F.xxhash64("x").alias("n0"), F.regexp_count("x", F.lit(WORD)).alias("words")
    ).where("words > 0")
    # Equal rows would stand in each other's way.
    lines = lines.dropDuplicates(["pos", "text_hash", "line"])
    w = Window.partitionBy("pos", "text_hash").orderBy("line")
    lines = lines.withColumns({
        "n": F.row_number().over(w) - 1,
        "upto": F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, 0)),
    }).withColumn("before", F.col("upto") - F.col("words"))
    sizes = range(1, least_words + 1)
    lines = lines.withColumns({
        "forward": F.coalesce(*(F.when(F.lead("upto", c - 1).over(w) - F.col("before") >= least_words, c) for c in sizes)),
        "backward": F.coalesce(*(F.when(F.col("upto") - F.lag("before", c - 1).over(w) >= least_words, c) for c in sizes)),
    })
    levels = least_words.bit_length()
    for k in range(1, levels):
        name, half = F.col(f"n{k - 1}"), F.lead(f"n{k - 1}", 1 << (k - 1)).over(w)
        lines = lines.withColumn(f"n{k}", F.when(half.isNotNull(), F.xxhash64(name, half)))
    runs = []
    for c in sizes:
        k = c.bit_length() - 1
        wanted = (F.col("forward") == c) | (F.lead("backward", c - 1).over(w) == c)
        key = F.xxhash64(F.lit(c), f"n{k}", F.lead(f"n{k}", c - (1 << k)).over(w))
        runs.append(F.when(wanted, F.struct(F.lit(c).alias("lines"), key.alias("key"))))
    each = lines.select("pos", "text_hash", "n", F.array_compact(F.array(*runs)).alias("runs"))
    return each.select("pos", "text_hash", "n", F.inline("runs"))


def repeated_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Lines to delete: pos, text_hash, gone (numbers among the lines with words)."""
    if least_words < 1:
        raise ValueError("a run needs at least one word")
    runs = line_runs(docs, least_words)
    at = F.struct("pos", "text_hash", "n")
    intervals = runs.groupBy("key").agg(F.min(at).alias("origin"), F.count(F.lit(1)).alias("members")).where("members > 1")
    later = runs.join(intervals.drop("members"), "key").where(at != F.col("origin"))
    numbers = later.select("pos", "text_hash", F.explode(F.sequence("n", F.col("n") + F.col("lines") - 1)).alias("number"))
    return numbers.groupBy("pos", "text_hash").agg(F.collect_set("number").alias("gone"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also where inner functions refer to it for every element."""
    return F.transform(F.array(value), use)[0]


def _without(lines: Column, gone: Column) -> Column:
    """The lines joined again, without those that are numbered in ``gone`` among the lines with words."""
    kept = lambda x, with_words: F.array_except(
        F.sequence(F.lit(0), F.size(x) - 1), F.transform(gone, lambda n: with_words[n])
    )
    numbers = lambda x: F.array_compact(F.transform(x, lambda line, i: F.when(line.rlike(WORD), i)))
    joined = lambda x, left: F.array_join(F.transform(left, lambda i: x[i]), "\n")
    return _let(lines, lambda x: _let(numbers(x), lambda w: _let(kept(x, w), lambda left: joined(x, left))))


def drop_repeated_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of ``docs`` with all their columns, the lines of later copies deleted from ``text``.

    Adds ``removed_lines`` (long). Of equal runs the one in the smallest ``doc_id``, and there the first line, stays; a
    null ``doc_id`` counts as the largest. Lines are split at \\n and compared as they are; lines without a word are
    no part of runs and stay. A null text stays null. Rows that are equal in ``doc_id`` and text are treated
    alike. An empty table gives no rows. Other columns come back as they are, whatever their names, but for
    a ``removed_lines`` that was there.
    """
    docs, moved = sheltered(docs.drop("removed_lines"), {"pos_", "text_hash_", "gone_"})
    gone = repeated_lines(docs.select("doc_id", "text"), least_words).select(
        F.col("pos").alias("pos_"), F.col("text_hash").alias("text_hash_"), F.col("gone").alias("gone_")
    )
    wide = docs.withColumns({"pos_": _position(), "text_hash_": F.xxhash64("text")}).join(gone, ["pos_", "text_hash_"], "left")
    text = F.when(F.col("gone_").isNull(), F.col("text")).otherwise(_without(F.split("text", "\n", -1), F.col("gone_")))
    removed = F.coalesce(F.size("gone_"), F.lit(0)).cast("long")
    wide = wide.withColumn("removed_lines", F.when(F.col("gone_").isNull(), 0).otherwise(removed).cast("long"))
    wide = wide.withColumn("text", text).select(*[f"`{c}`" for c in docs.columns], "removed_lines")
    return wide.withColumnsRenamed({free: name for name, free in moved.items()})
