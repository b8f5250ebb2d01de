"""SimHash classes against a brute-force version over all pairs."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tickerpulse.llm import op2_simhash as S

SF = "/root/testdata/sf0.001"


def brute_fp(text, n=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] if w else []
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs)) if hs else 0


def brute_components(fps, k):
    """index -> set of indices reachable"""
    left, out = set(range(len(fps))), {}
    while left:
        todo = [left.pop()]
        seen = set(todo)
        while todo:
            x = todo.pop()
            near = {y for y in left if bin(fps[x] ^ fps[y]).count("1") <= k}
            left -= near
            seen |= near
            todo += near
        for x in seen:
            out[x] = seen
    return out


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    fps = [brute_fp(r["text"]) for r in rows]
    comp = brute_components(fps, 2)
    want = {(r["doc_id"], f"{fps[i]:016x}", min(rows[j]["doc_id"] for j in comp[i])) for i, r in enumerate(rows)}
    got = [tuple(r) for r in S.near_dedup(docs).collect()]
    assert len(got) == len(rows) and set(got) == want


@pytest.mark.parametrize("k,crowd", [(1, 3), (2, 0), (2, 3), (2, 64), (3, 3)])
def test_links_of_planted_fingerprints(spark, k, crowd):
    """Chains, dense balls and random values; whatever the bound, the same components."""
    rng = random.Random(7 * k)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for _ in range(6):  # balls and chains
        x = rng.getrandbits(64)
        for _ in range(25):
            fps.add(x)
            y = x
            for _ in range(rng.randint(1, 3)):
                y ^= 1 << rng.randrange(64)
            fps.add(y)
            x = rng.choice([x, y])
    fps |= {0, 1, (1 << 64) - 1, 1 << 63}
    fps = sorted(fps)
    comp = brute_components(fps, k)
    want = {f: min(fps[j] - (1 << 64) if fps[j] >> 63 else fps[j] for j in comp[i]) for i, f in enumerate(fps)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = S.exact_links(spark.createDataFrame(signed, "fp long"), k, crowd)
    got = {r["node"]: r["root"] for r in S.components(links).collect()}
    for (f,), u in zip(signed, fps):
        assert got.get(f, f) == want[u]
    for r in links.collect():
        assert bin((r["a"] ^ r["b"]) & (1 << 64) - 1).count("1") <= k


def test_odd_rows(spark):
    long = "word another third " * 20000
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "One", "x"), (5, "one", "x"), (None, "one", "x"),
            (6, "one two", "x"), (7, long, "x"), (7, long, "x"), (8, "É É é b c", "x"), (None, "alone here now", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("component_id", F.lit("clash"))
    got = sorted(S.near_dedup(docs).collect(), key=str)
    fps = [brute_fp(r[1]) for r in rows]
    comp = brute_components(fps, 2)
    want = sorted(((r[0], f"{fps[i]:016x}", min((rows[j][0] for j in comp[i] if rows[j][0] is not None), default=None))
                   for i, r in enumerate(rows)), key=lambda t: str(t))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert S.near_dedup(docs.limit(0)).count() == 0
