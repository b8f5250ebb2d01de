"""Fingerprints, edits and neighbours against a plain version; block tables against all pairs."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerpulse.llm import op3_fingerprints as P
from tickerpulse.llm import queries as Q

SF = "/root/testdata/sf0.01"


def plain(rows, radius=7):
    """rows of (doc_id, text), in order of the operator -> expected tuples"""
    fps = [P.fingerprint(t or "") for _, t in rows]
    ints = [int.from_bytes(f, "little") for f in fps]
    out = []
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        e = P.fingerprint(edited)
        n = sum((ints[i] ^ x).bit_count() <= radius for x in ints) if d is not None and d % 20 == 0 else None
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), fps[i].hex(), e.hex(),
                    P.likeness(fps[i], e), P.likeness(fps[i], fps[(i + 1) % len(rows)]), n))
    return out


def same(got, want):
    got, want = sorted(map(tuple, got), key=str), sorted(want, key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[7] == w[7]
        assert g[5] == pytest.approx(w[5], abs=1e-12) and g[6] == pytest.approx(w[6], abs=1e-12)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = P.report(docs, lambda i: i % 20 == 0).collect()
    same(got, plain(rows))
    long = [r for r in got if r["n_chars"] > 400]
    assert np.mean([r["near_edited"] > r["near_next"] for r in long]) > 0.9
    assert np.mean([r["near_edited"] for r in long]) > 0.4 > 0.3 > np.mean([r["near_next"] for r in long])


def test_odd_rows(spark):
    rows = [(0, None), (1, ""), (2, "One two"), (4, "one TWO"), (5, "a"), (20, "x y " * 40000), (40, "one two"), (None, "last of all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("part", F.lit("z"))
    got = P.report(docs.repartition(3), lambda i: i % 20 == 0).collect()
    same(got, plain(rows))
    by = {r["doc_id"]: r for r in got}
    assert by[2]["fingerprint"] == by[4]["fingerprint"] and by[2]["near_next"] == 1.0 and by[40]["n_within"] == 3
    assert P.report(docs.limit(0), lambda i: i % 20 == 0).count() == 0
    one = P.report(docs.filter("doc_id = 2"), lambda i: i % 20 == 0).first()
    assert one["near_next"] == 1.0 and one["n_within"] is None
    twice = docs.filter("doc_id = 20").unionAll(docs.filter("doc_id = 20"))
    assert [r["n_within"] for r in P.report(twice, lambda i: i % 20 == 0).collect()] == [2, 2]


@pytest.mark.parametrize("radius,chunk", [(7, 2048), (5, 7), (0, 2)])
def test_tables_against_all_pairs(spark, monkeypatch, radius, chunk):
    monkeypatch.setattr(P, "CHUNK", chunk)
    rng = random.Random(radius)
    fps = []
    for _ in range(20):
        x = rng.getrandbits(P.BITS)
        for _ in range(12):
            y = x
            for _ in range(rng.randint(0, 9)):
                y ^= 1 << rng.randrange(P.BITS)
            fps += [y] * rng.randint(1, 2)
    df = spark.createDataFrame([(bytearray(f.to_bytes(32, "little")),) for f in fps], "fp binary")
    asked = spark.createDataFrame([(bytearray(f.to_bytes(32, "little")),) for f in fps[::3]], "fp binary")
    got = {bytes(r["fp"]): r["n"] for r in P.within(df, asked, radius).collect()}
    assert got == {f.to_bytes(32, "little"): sum((f ^ g).bit_count() <= radius for g in fps) for f in fps[::3]}


@pytest.mark.parametrize("radius,chunk", [(8, 2048), (15, 5), (23, 2048)])
def test_wider_radii_against_all_pairs(spark, monkeypatch, radius, chunk):
    monkeypatch.setattr(P, "CHUNK", chunk)
    rng = random.Random(radius)
    fps = []
    for _ in range(12):
        x = rng.getrandbits(P.BITS)
        for _ in range(12):
            y = x
            for b in rng.sample(range(P.BITS), rng.randint(0, radius)):
                y ^= 1 << b
            fps += [y] * rng.randint(1, 2)
        evenly = x  # radius bits dealt over all blocks as evenly as they go
        for b in range(radius):
            evenly ^= 1 << (32 * (b % 8) + rng.randrange(4) * 8 + b // 8)
        fps += [x, evenly]
    df = spark.createDataFrame([(bytearray(f.to_bytes(32, "little")),) for f in fps], "fp binary")
    asked = df.limit(60) if radius == 23 else df
    picked = {bytes(r["fp"]) for r in asked.collect()}
    got = {bytes(r["fp"]): r["n"] for r in P.within(df, asked, radius).collect()}
    assert got == {f: sum((int.from_bytes(f, "little") ^ g).bit_count() <= radius for g in fps) for f in picked}
    with pytest.raises(ValueError):
        P.tables(24)


def test_the_values_asked_for_are_not_broadcast(spark):
    """Each query's 264 values are written out only in the plan, where Spark goes by the small file of the queries."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "10m")
    try:
        df = spark.range(500).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("fp"))
        found = P.within(df, df, 15)
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        assert [r["n"] for r in found.collect()] == [1] * 500
    finally:
        spark.conf.set(key, before)


def test_a_replaced_word_is_found(spark, tmp_path):
    rng = random.Random(1)
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        near = list(words)
        near[rng.randrange(200)] = "replaced"
        rows += [(20 * i, " ".join(words)), (20 * i + 1, " ".join(near))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = [r["n_within"] for r in Q.op3_simhash_fingerprints(spark, str(tmp_path)).collect() if r["doc_id"] % 20 == 0]
    assert len(got) == 40 and sum(n >= 2 for n in got) >= 36  # within 7 bits, 9 of 40 by the advice's 22 %
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    same(Q.op3_simhash_fingerprints(spark, SF).collect(), plain(sorted(docs), 15))
