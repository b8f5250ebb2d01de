"""Spelling variants by the trie walk against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from tickerpulse.llm import op12_spelling as op


def one_edit(a, b):
    """By trying every edit."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows, every=97, shortest=5, least=3):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= shortest and n >= least}


def plain(rows, **options):
    words = plain_words(rows, **options)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def ran(spark, rows, schema="doc_id long, text string", **options):
    got = op.group(spark.createDataFrame(rows, schema), **options)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, got.collect()))


def random_rows(seed, letters="abé", docs=60, length=(4, 9)):
    draw = random.Random(seed)
    words = ["".join(draw.choice(letters) for _ in range(draw.randint(*length))) for _ in range(150)]
    return [(i, " ".join(draw.choice(words) for _ in range(40))) for i in range(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = random_rows(seed)
    got = ran(spark, rows)
    assert got == plain(rows) and sum(r[4] > 0 for r in got) > 30


def test_longer_alphabet_and_deletions(spark):
    rows = random_rows(3, "abcdefgh", 80, (5, 7))
    assert ran(spark, rows, every=3) == plain(rows, every=3)


def test_long_words_meet_by_their_remains(spark):
    draw = random.Random(9)
    base = "".join(draw.choice("abcd") for _ in range(60))
    words = [base, base[:10] + base[11:], base[:-1] + "z", base + "q", "x" + base, base[:47], base[:48], base[:49], base[:48] + "zz"]
    rows = [(i, " ".join(words)) for i in range(4)]
    assert ran(spark, rows) == plain(rows)
    short = random_rows(4)
    words = spark.createDataFrame([(w,) for w in plain_words(short)], "word string")
    for walk_to in (5, 6, 48):
        got = {tuple(r) for r in op.neighbours(words, walk_to).collect()}
        assert got == {(a, b) for a in plain_words(short) for b in plain_words(short) if one_edit(a, b)}


def test_chains_of_forms(spark):
    rows = [(1, "aaaaaa " * 100 + "aaaaab " * 50 + "aaaabb " * 25 + "aaabbb " * 12 + "aabbbb " * 6 + "abbbbb " * 3 + "zzzzz " * 3)]
    got = {r[0]: r for r in ran(spark, rows, every=10**9)}
    assert got["abbbbb"] == ("abbbbb", "aabbbb", "aaaaaa", 3, 1, 6)
    assert got["aaaaaa"] == ("aaaaaa", None, "aaaaaa", 100, 1, None)
    assert got["zzzzz"] == ("zzzzz", None, "zzzzz", 3, 0, None)


def test_ties_take_the_smallest_form(spark):
    rows = [(1, "bbbbx " * 8 + "bbbba " * 8 + "bbbbé " * 3)]
    assert [r for r in ran(spark, rows, every=10**9) if r[0] == "bbbbé"] == [("bbbbé", "bbbba", "bbbba", 3, 2, 8)]


def test_odd_rows(spark):
    rows = [(1, None), (None, "lower LOWER Lower"), (2, ""), (3, "Ünter ünter Ünter Ünter × ÷÷÷÷÷ ÷÷÷÷÷ ÷÷÷÷÷"), (3, "lower lowes lowes lowes"), (None, None),
            (4, "\U0001F600 ŁŁŁŁŁ word1word word1word")]
    assert ran(spark, rows) == plain(rows)
    assert ran(spark, []) == []
    assert ran(spark, [(1, "a bb ccc")]) == []


def test_very_long_runs(spark):
    run = "ab" * 30_000
    rows = [(i, f"{run} {run}a plane planes") for i in range(3)]
    got = {r[0]: r[4] for r in ran(spark, rows, every=10**9)}
    assert got == {run: 1, run + "a": 1, "plane": 1, "planes": 1}


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "hello hello hello hallo hallo hallo", "x", 3)], "doc_id long, text string, word string, n long")
    assert sorted(r["word"] for r in op.group(df, every=10**9).collect()) == ["hallo", "hello"]


def test_one_edit():
    draw = random.Random(2)
    for _ in range(3000):
        a, b = ("".join(draw.choice("ab") for _ in range(draw.randint(0, 5))) for _ in range(2))
        assert op.one_edit(a, b) == one_edit(a, b)
