"""Product codes with bounds against plain rounds."""

import hashlib
import math
import random

import numpy as np
import pytest

from tickerpulse.llm import op13_vector_codes as op


def plain(rows, parts=4, size=256, rounds=4):
    """{id: (code, error)} and the hash of the codebooks, in plain integers. ``rows``: (id, vector, label), ids distinct."""
    kept = sorted((i, [math.floor(x * 1024) for x in v]) for i, v, _ in rows
                  if v is not None and all(x is not None and math.isfinite(x) for x in v))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, v in kept[:size]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v in kept:
                members.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            for k, m in members.items():
                books[p][k] = [sum(xs) // len(m) for xs in zip(*m)]
    out = {}
    for i, v in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out[i] = ("".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


SCHEMA = "vec_id long, embedding array<float>, label int"


def drawn(n, width=8, seed=1, spread=0.5):
    draw = random.Random(seed)
    centres = [[draw.uniform(-1, 1) for _ in range(width)] for _ in range(6)]
    return [(i, [float(np.float32(c + draw.gauss(0, spread))) for c in draw.choice(centres)], draw.choice([None, 1, 2])) for i in range(n)]


def check(spark, rows, **options):
    got = [r.asDict() for r in op.report(spark.createDataFrame(rows, SCHEMA), **options).collect()]
    want, digest = plain(rows, **options)
    assert {r["vec_id"]: (r["code"], r["error"]) for r in got} == want
    assert {r["codebooks_sha256"] for r in got} == {digest}
    label = {i: x for i, _, x in rows}
    for r in got:
        assert r["label_error"] == sum(e for i, (_, e) in want.items() if label[i] == label[r["vec_id"]])
    return got


@pytest.mark.parametrize("size,rounds", [(20, 4), (256, 2), (1, 1), (40, 0)])
def test_against_plain_rounds(spark, size, rounds):
    check(spark, drawn(300), size=size, rounds=rounds)


def test_bounds_spare_distances(spark):
    rows = drawn(600, 16, 2, 0.02)
    got = check(spark, rows, size=64, rounds=4)
    assert sum(r["measured"] for r in got) < 0.6 * len(rows) * 4 * 64 * 5


def test_net_moves_are_no_longer_than_summed_ones():
    first = np.array([[0, 0], [10, 0]])
    there, back = first + 5, first + 1
    books = op.Codebooks([back], [np.array([0, 1])], [[first], [there], [back]])
    moves = op._net_moves(books, 0)
    assert np.allclose(moves[0], math.sqrt(2)) and np.allclose(moves[2], 0)


def test_odd_rows(spark):
    rows = drawn(30) + [(100, None, 1), (101, [1.0, None] * 4, 1), (102, [float("nan")] * 8, 2), (103, [float("inf")] * 8, None),
                        (-5, [0.25] * 8, None), (-4, [0.25] * 8, 7), (-3, [0.25] * 8, 7)]
    check(spark, rows, size=8)
    assert op.report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert op.report(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
    repeated = op.report(spark.createDataFrame([(1, [0.5] * 4, None), (1, [0.5] * 4, None), (None, [0.5] * 4, 1)], SCHEMA)).collect()
    assert sorted((r["vec_id"] or 0, r["code"], r["error"]) for r in repeated) == [(0, "00" * 4, 0), (1, "00" * 4, 0), (1, "00" * 4, 0)]
    empty = op.report(spark.createDataFrame([(1, [], 1), (2, [], 1)], SCHEMA)).collect()
    assert {(r["code"], r["error"]) for r in empty} == {("00" * 4, 0)}
    with pytest.raises(ValueError):
        op.report(spark.createDataFrame([(1, [0.5] * 4, 1), (2, [0.5] * 8, 1)], SCHEMA))
    with pytest.raises(ValueError):
        op.report(spark.createDataFrame([(1, [1e30] * 4, 1)], SCHEMA))


def test_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32(x * 2.0 ** 16)) for x in v], k) for i, v, k in drawn(60, 4, 7)]
    check(spark, rows, size=10, rounds=2)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, v, k, 1, "c", 2) for i, v, k in drawn(20)], SCHEMA + ", id int, code string, error int")
    assert op.report(df, size=4).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256", "measured"]
