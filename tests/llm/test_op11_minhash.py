"""Classes by fast similarity sketching against all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerpulse.llm import op11_minhash as op

WORDS = re.compile("[^\x20\x09-\x0D]+")


def plain_set(text, shingle=2):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) <= shingle:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)}


def plain(rows, shingle=2, percent=80):
    """(id, n, component, kept) by all pairs and breadth-first search."""
    sets = [plain_set(t, shingle) for _, t in rows]
    links = {i: set() for i in range(len(rows))}
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            links[i].add(j)
            links[j].add(i)
    out, seen = [], {}
    for i in links:
        if i not in seen:
            group, todo = {i}, [i]
            while todo:
                for k in links[todo.pop()] - group:
                    group.add(k)
                    todo.append(k)
            ids = [rows[k][0] for k in group if rows[k][0] is not None]
            seen |= {k: min(ids, default=None) for k in group}
        out.append((rows[i][0], len(sets[i]), seen[i], rows[i][0] == seen[i]))
    return out


def ran(spark, rows, schema="doc_id long, text string", **options):
    return [tuple(r) for r in op.near_dedup(spark.createDataFrame(rows, schema), shingle=2, percent=80, **options).collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def near_copies(seed=1):
    """Texts of 3 to 60 words and copies of them with up to 40 % of the words replaced."""
    draw = random.Random(seed)
    texts = []
    for _ in range(12):
        words = [f"w{draw.randrange(400)}" for _ in range(draw.randint(3, 60))]
        for _ in range(draw.randint(1, 12)):
            copy = list(words)
            for _ in range(draw.randint(0, max(1, len(words) // 8))):
                copy[draw.randrange(len(copy))] = f"w{draw.randrange(400)}"
            texts.append(" ".join(copy))
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("crowd", [op.CROWD, 2])
def test_against_all_pairs(spark, crowd):
    rows = near_copies()
    assert order(ran(spark, rows, crowd=crowd)) == order(plain(rows))


def test_crowded_buckets_of_several_classes(spark):
    # one template of which every text shares about 70 %, so buckets are shared by texts that do not link; a few pairs do
    draw = random.Random(5)
    template = [f"t{i}" for i in range(70)]
    rows = []
    for i in range(60):
        own = [f"o{i}x{j}" for j in range(24)]
        rows.append((2 * i, " ".join(template + own)))
        if i % 3 == 0:
            own[draw.randrange(24)] = "changed"
            rows.append((2 * i + 1, " ".join(template + own)))
    got = ran(spark, rows, crowd=3)
    assert order(got) == order(plain(rows))
    assert sum(1 for r in got if not r[3]) == 20


def test_odd_rows(spark):
    rows = [(7, None), (3, None), (5, ""), (9, " \t\n"), (4, "one"), (8, "ONE"), (2, "one two"), (6, "One  Two"),
            (None, "one two"), (None, None), (2, "one two"), (11, "É x"), (12, "é x")]
    assert order(ran(spark, rows)) == order(plain(rows))
    assert ran(spark, []) == []
    only_null = ran(spark, [(None, "a b c"), (None, "a b c")])
    assert only_null == [(None, 2, None, True)] * 2


def test_clashing_columns_and_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(120_000))
    rows = [(1, long, 1, 2), (2, long + " end", 1, 2), (3, "x y z", None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node int, n int").withColumn("key", F.lit(1)).withColumn("root", F.lit("r"))
    got = op.near_dedup(df, shingle=2, percent=80)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert order(map(tuple, got.collect())) == [(1, 119_999, 1, True), (2, 120_000, 1, False), (3, 2, 3, True)]


def test_hot_copies_and_text_ids(spark):
    rows = [(f"id{i:04}", "same old text again") for i in range(400)] + [("z", "another text")]
    got = ran(spark, rows, "doc_id string, text string")
    assert {r[2] for r in got if r[0] != "z"} == {"id0000"} and sum(r[3] for r in got) == 2


def test_sketch_fills_every_coordinate_and_estimates_similarity():
    draw = np.random.default_rng(3)
    pool = draw.integers(0, 2**63, 3000, dtype=np.uint64)
    sizes = [1, 2, 5, 40, 1000]
    one = op.sketches([np.sort(pool[:n]) for n in sizes])
    assert (one != op._EMPTY).all()
    apart = np.concatenate([op.sketches([np.sort(pool[:n])]) for n in sizes])
    assert (one == apart).all()  # a sketch depends on its set alone
    shares = []
    for _ in range(60):
        x = draw.permutation(pool)
        a, b = op.sketches([x[:900], x[100:1000]])
        shares.append((a == b).mean())
    assert abs(np.mean(shares) - 0.8) < 0.02


def test_band_recall_at_the_threshold():
    draw = np.random.default_rng(4)
    missed = 0
    for _ in range(300):
        x = draw.integers(0, 2**63, 100, dtype=np.uint64)
        a, b = op.band_keys(op.sketches([x[:90], x[10:]]))
        missed += not (a == b).any()
    assert missed == 0
