"""Near-duplicates, repeated strings, repeated lines and quality rules against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from siltstone.llm import queries
from siltstone.llm.bbit_minhash import Near, near_duplicates
from siltstone.llm.frames import components
from siltstone.llm.line_runs import drop_repeated_lines
from siltstone.llm.repetition import COUNTS, Rules, good_documents, quality
from siltstone.llm.suffix_levels import Strings, drop_repeated_strings

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def documents(spark, rows):
    """Rows (doc_id, text) with further columns, among them names that operators use inside."""
    return spark.createDataFrame(
        [(d, t, "x", d, "src", t) for d, t in rows],
        "doc_id long, text string, part string, pos long, source string, kept string",
    )


def words(seed, n):
    draw = random.Random(seed)
    return [draw.choice(["alpha", "Beta", "gamma,", "délta", "eps", "zeta."]) + str(draw.randrange(40)) for _ in range(n)]


def odd_texts():
    base = words(1, 300)
    near = [*base[:150], "other", *base[151:]]
    far = [*base[:60], *words(2, 240)]
    return [
        (1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, " ".join(far)), (5, None), (6, ""), (7, " \n\t "),
        (8, "one two three"), (9, "ONE two\nthree"), (10, "a " * 3000), (11, "a " * 2999), (12, " ".join(words(3, 30_000))),
        (13, "x" * 49), (14, "x" * 50), (15, "x" * 200), (15, "x" * 200), (None, " ".join(base)), (None, None),
        (16, "l1 " + " ".join(words(4, 12)) + "\n" + " ".join(words(5, 12)) + "\nend"),
        (17, " ".join(words(5, 12)) + "\n\n" + " ".join(words(5, 12)) + "\nend"),
    ]


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def linked(rows):
    sets = {d: shingles(t) for d, t in rows if d is not None}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (500, 501), (501, 500)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys(range(100, 160), 100), 500: 500, 501: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_odd_rows(spark):
    rows = odd_texts()
    want = linked(rows)
    got = near_duplicates(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for row in got:
        if row.doc_id is None:
            assert row.kept and row.component_id is None
        else:
            assert (row.n_shingles, row.component_id, row.kept) == (*want[row.doc_id], want[row.doc_id][1] == row.doc_id)


def test_near_duplicates_of_a_group_below_the_threshold(spark):
    """Members share most bands with the smallest, but only neighbours are linked."""
    base = words(9, 400)
    rows = []
    for k in range(40):
        own = list(base)
        for j in range(k):
            own[j * 9 % 400] = f"new{j}"
        rows.append((k, " ".join(own)))
    want = linked(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(documents(spark, rows)).collect()}
    assert got == want


def test_near_duplicates_of_repeated_ids_with_different_texts(spark):
    one, two, three, four = (" ".join(words(k, 60)) for k in (21, 22, 23, 24))
    rows = [(1, one), (5, one), (5, two), (5, ""), (7, two), (20, three), (21, four), (30, three), (30, four), (40, ""), (41, None)]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(documents(spark, rows)).collect())
    want = {1: 1, 5: 1, 7: 1, 20: 20, 21: 20, 30: 20, 40: 40, 41: 41}
    assert got == sorted((d, want[d], want[d] == d) for d, _ in rows)


def test_near_duplicates_do_not_compare_blank_texts_of_repeated_ids(spark):
    """Candidates whose own texts are too different, while their blank rows would be equal."""
    near = Near(percent=90, bands=64, rows=1, deviations=50.0)
    base = words(31, 300)
    rows = [(k, " ".join(base[k * 20 : k * 20 + 150])) for k in range(4)] + [(k, "") for k in range(4)]
    got = near_duplicates(documents(spark, rows), near).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((d, d) for d, _ in rows)


def test_near_duplicates_of_an_empty_table(spark):
    assert near_duplicates(documents(spark, [])).count() == 0


def test_near_duplicates_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op9_bbit_minhash(spark, SMALL).collect()}
    assert got == linked(rows)


def test_estimates_allow_for_chance():
    assert 60 < Near().least_equal < 96


def covered(rows, width):
    out, seen = {}, {}
    for _, text in rows:
        b = (text or "").encode()
        for i in range(len(b) - width + 1):
            seen.setdefault(b[i : i + width], set())
    big = 1 << 62
    for d, text in rows:
        b = (text or "").encode()
        for i in range(len(b) - width + 1):
            seen[b[i : i + width]].add(big if d is None else d)
    first = {w: min(s) for w, s in seen.items()}
    for d, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] < (big if d is None else d):
                gone[i : i + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.setdefault(d, []).append((len(b), spans, kept))
    return {d: sorted(v) for d, v in out.items()}


@pytest.mark.parametrize("width, head", [(50, 20), (7, 7), (12, 3)])
def test_repeated_strings_of_odd_rows(spark, width, head):
    rows = [(d, t if t is None else t[:6000]) for d, t in odd_texts()]
    got = {}
    for r in drop_repeated_strings(documents(spark, rows), Strings(width, head, 3)).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, len(r.removed), bytes(r.kept)))
    assert {d: sorted(v) for d, v in got.items()} == covered(rows, width)


def test_repeated_strings_across_slices(spark, monkeypatch):
    """A document longer than a slice is read in pieces."""
    draw = random.Random(4)
    long = "".join(draw.choice("abcdefgh") for _ in range(2_300_000))
    rows = [(1, long), (2, long[1_048_500:1_048_700] + "-" + long[5:60] + "-" + long[2_299_900:])]
    got = {r.doc_id: r for r in drop_repeated_strings(documents(spark, rows)).collect()}
    assert len(got[1].kept) == len(long) and not got[1].removed
    assert bytes(got[2].kept) == b"--" and len(got[2].removed) == 3


def test_repeated_strings_of_an_empty_table(spark):
    assert drop_repeated_strings(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        Strings(width=10, head=11)


def test_repeated_strings_of_the_table(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    want = covered(rows, 50)
    for r in queries.op8_suffix_levels(spark, SMALL).collect():
        ((n, spans, kept),) = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n, n - len(kept), spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def deduped_lines(rows, least):
    """Maximal runs by trying all runs: text of each row."""
    def key(d):
        return (d is None, d)

    held = []
    for d, text in rows:
        lines = [] if text is None else text.split("\n")
        held.append((d, text, lines, [i for i, x in enumerate(lines) if WORD.search(x)]))
    first = {}
    for d, text, lines, on in sorted(held, key=lambda h: key(h[0])):
        for a in range(len(on)):
            for b in range(a, min(len(on), a + 30)):
                run = tuple(lines[i] for i in on[a : b + 1])
                first.setdefault(run, (key(d), text, a))
    out = []
    for d, text, lines, on in held:
        gone = set()
        for a in range(len(on)):
            for b in range(a, min(len(on), a + 30)):
                run = tuple(lines[i] for i in on[a : b + 1])
                if sum(len(WORD.findall(x)) for x in run) >= least and first[run] != (key(d), text, a):
                    gone |= set(on[a : b + 1])
        out.append((d, text if text is None or not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [1, 5, 10])
def test_repeated_lines(spark, least):
    rows = odd_texts()
    rows += [(20 + k, "\n".join(" ".join(words(random.Random(k * 7 + i).randrange(6), 1 + i % 4)) for i in range(9))) for k in range(8)]
    rows += [(40, "\n\n"), (41, "same line of text here\n" * 3 + "tail")]
    got = drop_repeated_lines(documents(spark, rows), least)
    assert got.columns == ["doc_id", "text", "part", "pos", "source", "kept", "removed_lines"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == deduped_lines(rows, least)


def test_repeated_lines_of_odd_tables(spark):
    assert drop_repeated_lines(documents(spark, [])).count() == 0
    named = documents(spark, [(1, "a b c\na b c"), (2, "a b c")]).withColumnsRenamed({"part": "gone_", "pos": "POS_", "kept": "removed_lines"})
    got = drop_repeated_lines(named, 3)
    assert got.columns == ["doc_id", "text", "gone_", "POS_", "source", "removed_lines"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a b c", "x", 1, "src", 1), (2, "", "x", 2, "src", 1)]
    with pytest.raises(ValueError):
        drop_repeated_lines(documents(spark, []), 0)


def test_repeated_lines_stay_native(spark):
    plan = drop_repeated_lines(documents(spark, odd_texts()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def measured(text):
    w, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    counts = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if counts[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    longest = 0
    if len(w) <= 400:
        longest = max((n for n in range(1, len(w)) if len({tuple(w[i : i + n]) for i in range(len(w) - n + 1)}) < len(w) - n + 1), default=0)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)), longest


def test_quality_of_odd_rows(spark):
    rows = [*odd_texts(), (30, "# a|b <c>\n# a|b <c>\n" * 4), (31, "α β γ α β γ δ")]
    got = quality(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for row, (d, text) in zip(got, rows, strict=True):
        want, longest = measured(text)
        assert (row.doc_id, tuple(row[c] for c in COUNTS[:5])) == (d, want)
        if want[0] <= 400:
            assert row.longest_repeat == longest
        assert row.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    kept = [(r.doc_id) for r in got if r.kept]
    passed = good_documents(documents(spark, rows).withColumnRenamed("part", "measured"))
    assert passed.columns == ["doc_id", "text", "measured", "pos", "source", "kept"]
    assert [r.doc_id for r in passed.collect()] == kept and 1 in kept and 10 not in kept


def test_quality_rejects_long_repeats(spark):
    plain, block = words(11, 200), words(12, 60)
    rows = [(1, " ".join(plain)), (2, " ".join([*block, *plain[:70], *block, *plain[70:90], *block[:40]]))]
    got = {r.doc_id: r for r in quality(documents(spark, rows), Rules(repeat_percent=100)).collect()}
    assert got[1].kept and not got[2].base_failed and not got[2].kept
    assert got[2].longest_repeat == 60 and got[2].n_covered_words == 160


def test_quality_of_an_empty_table(spark):
    assert quality(documents(spark, [])).count() == 0 and good_documents(documents(spark, [])).count() == 0
