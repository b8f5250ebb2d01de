"""SimHash near-duplicate classes with pigeonring filtering.

A document's fingerprint is the bitwise majority of the 64-bit hashes of its
word shingles. Fingerprints link when they differ in at most ``max_bits``
bits, and a class is a connected component of links.

**Pigeonring.** Cut the 64 bits, seen as a ring, into ``m = 2 * max_bits + 1``
segments. If two fingerprints differ in at most ``max_bits`` bits, there is a
segment from which every chain of ``l`` consecutive segments differs in at
most ``l * max_bits / m`` bits. For ``l = 2`` that budget is below one, so
two consecutive segments agree exactly: they are the join key (for 2 bits
about 26 of the 64 bits, 5 keys a fingerprint). Longer chains must keep
their budgets too before the full Hamming distance is taken.

**Crowded keys.** A key shared by more than ``CROWD`` different fingerprints
would make a quadratic number of pairs. Its members instead emit every
fingerprint within ``floor(max_bits / 2)`` bits of theirs (and, for an odd
radius, those at one bit more, marked): two fingerprints share such a
midpoint exactly if they are within ``max_bits``. One midpoint has at most 65
different members for 2 bits, so star links from its smallest member lose
nothing and stay linear. Every pair in reach shares a ring key, and is found
by one way or the other, so the result is the same wherever the bound lies.

Only different fingerprints enter the search, so copies cost nothing there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, row_key, stored, text_batches
from .components import components

BITS = 64
#: Different fingerprints that may share a ring key and still be paired directly.
CROWD = 64

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_WEIGHTS = np.left_shift(np.uint64(1), np.arange(BITS, dtype=np.uint64))


def majority(hashes: np.ndarray, weights: np.ndarray | None = None) -> int:
    """The bits set in over half of the (weighted) 64-bit hashes; 0 for none."""
    if not len(hashes):
        return 0
    if weights is None and len(hashes) < 200:
        ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total = len(hashes)
    else:  # counts of byte values per place: cheaper than one add a bit
        at = hashes.view(np.uint8).reshape(-1, 8) + np.arange(8, dtype=np.int64) * 256
        w = None if weights is None else np.repeat(weights, 8)
        ones = (np.bincount(at.ravel(), weights=w, minlength=2048).reshape(8, 256) @ _BYTE_BITS).ravel()
        total = len(hashes) if weights is None else weights.sum()
    return int(_WEIGHTS[ones * 2 > total].sum(dtype=np.uint64))


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle, repeats included."""
    # bytes.lower() folds A-Z alone and bytes.split() splits at space and 0x09-0x0D alone
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, 42)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    begins = (ends - sizes)[:len(words) - shingle + 1].tolist()
    ends = (ends - 1)[shingle - 1:].tolist()
    return np.fromiter((digest(joined[i:j], 42) for i, j in zip(begins, ends)), np.uint64, len(begins))


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with the column ``fp``: the fingerprint as a signed 64-bit integer.

    A text of fewer words than the shingle is hashed whole; NULL, empty and
    blank texts have fingerprint 0.
    """
    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([majority(shingle_hashes(t, shingle)) for t in texts], np.uint64).view(np.int64))
    return text_batches(docs).withColumn("fp", fp(F.col(text)))


def fingerprint_hex(fp):
    """Column: 16 lower-case hex digits of a signed 64-bit fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def ring(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments."""
    m = 2 * max_bits + 1
    edges = [BITS * i // m for i in range(m + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(m)]


def _chain(value, segments, start: int, length: int):
    """Column: the bits of ``length`` consecutive segments of the ring from ``start``."""
    first = segments[start][0]
    width = sum(segments[(start + j) % len(segments)][1] for j in range(length))
    turned = value if not first else F.shiftrightunsigned(value, first).bitwiseOR(F.shiftleft(value, BITS - first))
    return turned.bitwiseAND(F.lit((1 << width) - 1)) if width < BITS else turned


def exact_links(fps: DataFrame, max_bits: int = 2, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between different fingerprints whose components equal those of
    all pairs within ``max_bits`` bits. ``fps`` has one column ``fp``, each value once."""
    segments = ring(max_bits)
    m = len(segments)
    keys = fps.select("fp", F.posexplode(F.array(*[_chain(F.col("fp"), segments, i, min(2, m)) for i in range(m)]))
                      .alias("start", "bits"))
    shared = stored(keys.groupBy("start", "bits").agg(F.count("*").alias("n")).filter("n > 1"), "ring-keys")
    members = stored(keys.join(shared, ["start", "bits"]), "ring-members")
    sparse = members.filter(F.col("n") <= crowd).drop("n")
    left = sparse.select("start", "bits", F.col("fp").alias("a"))
    right = sparse.select("start", "bits", F.col("fp").alias("b"))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    keeps = F.lit(True)
    for length in range(3, m):  # every longer chain from the start keeps its budget
        budget = length * max_bits // m
        within = F.lit(False)
        for i in range(m):
            within = within | ((F.col("start") == i) & (F.bit_count(_chain(diff, segments, i, length)) <= budget))
        keeps = keeps & within
    pairs = (left.join(right, ["start", "bits"]).filter(F.col("a") < F.col("b"))
             .filter(keeps).filter(F.bit_count(diff) <= max_bits).select("a", "b"))
    crowded = members.filter(F.col("n") > crowd).select("fp").distinct()
    return pairs.unionByName(_midpoint_links(crowded, max_bits)).distinct()


def _midpoint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    def flips(sizes):
        masks = [sum(1 << b for b in c) for s in sizes for c in combinations(range(BITS), s)]
        return [x - (1 << BITS) if x >= 1 << (BITS - 1) else x for x in masks]
    near = fps.select("fp", F.lit(True).alias("inner"), F.explode(F.expr(_array(flips(range(max_bits // 2 + 1))))).alias("mask"))
    if max_bits % 2:
        near = near.unionByName(fps.select("fp", F.lit(False).alias("inner"), F.explode(
            F.expr(_array(flips([max_bits // 2 + 1])))).alias("mask")))
    balls = near.select("fp", "inner", F.col("fp").bitwiseXOR(F.col("mask")).alias("mid"))
    groups = (balls.groupBy("mid").agg(F.min(F.expr("CASE WHEN inner THEN fp END")).alias("a"),
                                       F.collect_list("fp").alias("all"))
              .filter(F.col("a").isNotNull() & (F.size("all") > 1)))
    return groups.select("a", F.explode("all").alias("b")).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _array(values: list[int]) -> str:
    return "array(" + ", ".join(f"CAST({v} AS BIGINT)" if v != -(1 << 63) else "CAST('-9223372036854775808' AS BIGINT)" for v in values) + ")"


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
               max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (hex) and ``component_id``,
    the smallest id in its class.

    ``max_bits`` is at least 1. Repeated rows stay repeated, in one class. A NULL id is kept and never the
    smallest unless its class has no other; NULL, empty and blank texts share
    fingerprint 0 and link like any other. Extra columns of ``docs`` are not
    read. An empty table gives an empty one.
    """
    rows = stored(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text).alias("t")), "t", shingle)
                  .select("id", "fp"), "simhash")
    rooted = stored(_rooted(rows, max_bits), "simhash-rooted")
    smallest = stored(rooted.groupBy(F.col("root").alias("of")).agg(F.min("id").alias("component_id")), "simhash-smallest")
    return (rooted.join(smallest, rooted["root"] == smallest["of"])
            .select(F.col("id").alias(id_col), fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id"))


def _rooted(rows: DataFrame, max_bits: int) -> DataFrame:
    """``rows`` (stored, with ``fp``) with ``root``, one fingerprint of the row's class."""
    links = stored(exact_links(stored(rows.select("fp").distinct(), "simhash-distinct"), max_bits), "simhash-links")
    roots = stored(components(links), "simhash-roots")
    return rows.join(roots, rows["fp"] == roots["node"], "left").drop("node").withColumn("root", F.coalesce("root", "fp"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the smallest id (NULL last),
    of rows that share it the one with the smallest hash of all its columns.

    Rows equal in all columns, NULLs included, count as one; columns of any name are kept. Texts are moved once, to meet the chosen keys.
    """
    key = free_name("_key", docs.columns)
    keyed = docs.withColumn(key, row_key(docs.columns))
    rows = stored(fingerprints(keyed.select(F.col(id_col).alias("id"), F.col(key).alias("_key"), F.col(text).alias("t")), "t", shingle)
                  .select("id", "_key", "fp"), "simhash")
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "_key"))
    best = _rooted(rows, max_bits).groupBy("root").agg(first.alias("b")).select(F.col("b._key").alias("_key"))
    same = rows.groupBy("_key").agg(F.count("*").alias("_same"))
    chosen = stored(best.join(same, "_key"), "simhash-chosen")
    # the keys grow with the documents, so they are never broadcast; both joins share one shuffle of the texts
    once = keyed.join(chosen.filter("_same = 1").select(F.col("_key").alias(key)).hint("merge"), key)
    more = keyed.join(chosen.filter("_same > 1").select(F.col("_key").alias(key)).hint("merge"), key).dropDuplicates([key])
    return once.unionByName(more).select(*[f"`{c}`" for c in docs.columns])
