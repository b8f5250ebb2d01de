"""MinHash near-duplicate classes by fast similarity sketching.

A document is the set of its distinct word shingles. Two documents link when
the Jaccard similarity of their sets reaches ``percent`` / 100, and a class is
a connected component of links.

**Sketch.** ``COORDINATES`` bins are filled in up to twice as many rounds. In
each of the first ``COORDINATES`` rounds every element of the set falls into
one bin by a fresh hash; a bin keeps the smallest (round, value) that it has
met. The second half of the rounds sends all elements to one bin each, so
every coordinate is filled, and a set is done as soon as all of its bins are.
The bins behave like sampling without replacement first, so the share of equal
coordinates is concentrated about the similarity at least as well as with
independent hashes, at a cost of a few hashes an element.

**Banding.** ``ROWS`` coordinates make a band. With 32 bands of 4 a pair at
similarity 0.8 misses every band with probability (1 - 0.8^4)^32, 5e-8.

**Crowded buckets.** Equal sets are one node, so copies cost nothing. A bucket
of more than ``CROWD`` nodes does not make all pairs: its members are first
verified against its smallest and its largest node, and classes formed. Buckets that still
hold several classes hand their nodes to a prefix join, which is exact: with
the shingles in ascending order of frequency, two sets of similarity s share
one among the first n - ceil(s * n) + 1 of each, and the first that they share
leaves room for as many as the similarity asks for. Only nodes of different classes are paired there. Every pair that shares a bucket is thus verified or
already in one class.

**Verification** counts common shingles of the full sets. Shingles are told
apart by 64-bit hashes there; the set sizes are counted on the strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_batches
from .components import components

COORDINATES = 128
ROWS = 4
#: Different sets that may share a bucket and still be paired directly.
CROWD = 16

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, shingle: int) -> tuple[int, np.ndarray]:
    """Number of distinct word shingles and their sorted 64-bit hashes; words by A-Z lower-cased bytes."""
    # bytes.lower() folds A-Z alone and bytes.split() splits at space and 0x09-0x0D alone
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0, np.empty(0, np.uint64)
    if len(words) <= shingle:
        found = {b" ".join(words)}
    elif shingle == 2:
        found = {a + b" " + b for a, b in zip(words, words[1:])}
    else:
        found = {b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)}
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, found), np.uint64, len(found))
    hashes.sort()
    return len(found), hashes


def sketches(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketches of non-empty sets of 64-bit hashes: one row of ``t`` coordinates each.

    A coordinate holds the round in its top 8 bits and 56 bits of value, so the smallest integer is the smallest (round, value).
    """
    if t & (t - 1) or t > 128:
        raise ValueError("the number of coordinates is a power of two up to 128")
    out = np.full((len(sets), t), _EMPTY)
    if not sets:
        return out
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    elements, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    flat, places = out.ravel(), np.uint64(t - 1)
    for turn in range(2 * t):
        value = _mixed(elements + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        if turn < t:
            place = (value & places).astype(np.int64)
        else:
            place = np.full(len(elements), turn - t)
        np.minimum.at(flat, owner * t + place, (np.uint64(turn) << np.uint64(56)) | (value >> np.uint64(8)))
        open_ = (out == _EMPTY).any(axis=1)
        if not open_.any():
            break
        stays = open_[owner]
        if not stays.all():
            elements, owner = elements[stays], owner[stays]
    return out


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of each sketch; bands are told apart by their place."""
    n, t = sketch.shape
    parts = sketch.reshape(n, t // rows, rows)
    keys = np.broadcast_to(_mixed(np.arange(1, t // rows + 1, dtype=np.uint64)), (n, t // rows)).copy()
    for i in range(rows):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys.view(np.int64)


def _sketched(docs: DataFrame, shingle: int, rows: int) -> DataFrame:
    """(id, n, digest, text_key, bands) of each row (id, t); digest and bands are NULL for an empty set."""
    @F.pandas_udf("n long, digest binary, bands array<long>")
    def drawn(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [shingle_set(t, shingle) for t in texts]
            bands = iter(band_keys(sketches([h for n, h in found if n]), rows))
            yield pd.DataFrame({"n": np.array([n for n, _ in found], np.int64),
                                "digest": pd.Series([xxhash.xxh3_128_digest(h.tobytes()) if n else None for n, h in found], dtype=object),
                                "bands": pd.Series([next(bands) if n else None for n, _ in found], dtype=object)})
    return (text_batches(docs).withColumn("s", drawn("t"))
            .select("id", "s.n", "s.digest", F.unhex(F.md5(F.coalesce("t", F.lit("")))).alias("text_key"), "s.bands"))


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, h) of each row (node, t): the sorted hashes of the whole set."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield pd.DataFrame({"node": frame["node"], "h": [shingle_set(t, shingle)[1].view(np.int64) for t in frame["t"]]})
    return text_batches(texts).mapInPandas(run, "node long, h array<long>")


def _ratio(a, b, percent: int):
    """Column: sets of sizes a and b can reach the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose whole sets are similar enough."""
    # b first: rows that carry a set weigh alike, so adaptive execution sees and splits a frequent a
    right = sets.select(F.col("node").alias("b"), F.col("h").alias("hb"))
    left = sets.select(F.col("node").alias("a"), F.col("h").alias("ha"))
    both = F.size(F.array_intersect("ha", "hb"))
    return (pairs.join(right, "b").join(left, "a").withColumn("both", both)
            .filter(F.col("both") * 100 >= (F.size("ha") + F.size("hb") - F.col("both")) * percent).select("a", "b"))


def _sides(members: DataFrame, *more: str) -> DataFrame:
    """``members`` joined with themselves by key: columns of the one end in 1, of the other in 2."""
    left, right = (members.select("key", *[F.col(c).alias(f"{c}{i}") for c in ("node", "n", *more)]) for i in (1, 2))
    return left.join(right, "key").filter("node1 < node2")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("node1").alias("a"), F.col("node2").alias("b")).distinct()


def _rooted(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    roots = roots.select(F.col("node").alias("of"), "root")
    return nodes.join(roots, F.col("node") == F.col("of"), "left").drop("of").withColumn("root", F.coalesce("root", "node"))


def _prefixes(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, node, n, root, at): each node under those shingles of its prefix that another node holds too, at their places in the order."""
    own = stored(nodes.join(sets, "node").select("node", "n", "root", F.explode("h").alias("key")), "fss-shingles")
    often = stored(own.groupBy("key").agg(F.count("*").alias("df")).filter("df > 1"), "fss-frequency")
    # shingles that no other node holds come first in the order and match nothing: they shorten the prefix of the rest
    met = stored(own.join(often, "key"), "fss-met")
    held = met.groupBy("node").agg(F.count("*").alias("held")).select(F.col("node").alias("of"), "held")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("df", "key"))  # a set at most
    return (met.join(held, F.col("node") == F.col("of")).withColumn("at", F.col("n") - F.col("held") + rank)
            .filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).select("key", "node", "n", "root", "at"))


def _prefix_pairs(held: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different roots whose first common shingle leaves enough places for the common shingles that the similarity asks for."""
    left = 1 + F.least(F.col("n1") - F.col("at1"), F.col("n2") - F.col("at2"))
    return _ends(_sides(held, "root", "at").filter("root1 <> root2").filter(left * (100 + percent) >= (F.col("n1") + F.col("n2")) * percent))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80,
               rows: int = ROWS, crowd: int = CROWD) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles``, ``component_id`` (the smallest
    id of its class) and ``kept`` (the id is the smallest).

    A text of fewer words than the shingle is one shingle; NULL texts and
    texts without words have no shingle, link with nothing and are their own
    class. Repeated rows stay repeated, in one class. A NULL id is kept as a
    row and is the smallest only where its class has no other. Extra columns
    of ``docs`` are not read. An empty table gives an empty one.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    drawn = stored(_sketched(source, shingle, rows), "fss-sketched")
    nodes = stored(drawn.filter("n > 0").groupBy("digest").agg(F.first("n").alias("n"), F.min("text_key").alias("text_key"),
                                                              F.first("bands").alias("bands"))
                   .withColumn("node", F.monotonically_increasing_id()), "fss-nodes")
    keys = nodes.select(F.explode("bands").alias("key"), "node", "n")
    shared = stored(keys.groupBy("key").agg(F.count("*").alias("many"), F.min("node").alias("first"), F.max("node").alias("last")).filter("many > 1"), "fss-buckets")
    members = stored(keys.join(shared, "key"), "fss-members")
    few, many = members.filter(F.col("many") <= crowd), members.filter(F.col("many") > crowd)

    # nodes of full buckets meet their bucket's first and last node whatever their sizes, so that all of them have sets below
    stars = many.select(F.explode(F.array("first", "last")).alias("star"), "node").filter("star <> node") \
        .select(F.least("star", "node").alias("a"), F.greatest("star", "node").alias("b")).distinct()
    pairs = stored(_ends(_sides(few).filter(_ratio(F.col("n1"), F.col("n2"), percent))).unionByName(stars).distinct(), "fss-pairs")
    asked = stored(pairs.select(F.explode(F.array("a", "b")).alias("of")).distinct()
                   .join(nodes, F.col("of") == F.col("node")).select("node", "text_key"), "fss-asked")
    texts = (source.filter("t IS NOT NULL").select(F.unhex(F.md5("t")).alias("text_key"), "t")
             .groupBy("text_key").agg(F.first("t").alias("t")))
    sets = stored(_sets(texts.join(asked, "text_key").select("node", "t"), shingle), "fss-sets")
    links = stored(verified(pairs, sets, percent), "fss-links")
    roots = stored(components(links), "fss-roots")

    crowded = stored(_rooted(many.select("key", "node", "n"), roots), "fss-crowded")
    torn = crowded.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
    rest = stored(crowded.join(torn, "key").select("node", "n", "root").distinct(), "fss-rest")
    if not rest.isEmpty():
        held = stored(_prefixes(rest, sets, percent), "fss-prefixes")
        more = verified(stored(_prefix_pairs(held, percent), "fss-more"), sets, percent)
        links = stored(links.unionByName(more), "fss-all-links")
        roots = stored(components(links), "fss-all-roots")

    rooted = stored(_rooted(nodes.select("node", F.col("digest").alias("d")), roots).select("d", "root"), "fss-rooted")
    placed = stored(drawn.filter("n > 0").join(rooted, F.col("digest") == F.col("d")).select("id", "n", "root"), "fss-placed")
    smallest = stored(placed.groupBy(F.col("root").alias("of")).agg(F.min("id").alias("component_id")), "fss-smallest")
    found = placed.join(smallest, F.col("root") == F.col("of")).select("id", "n", "component_id")
    alone = drawn.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return found.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                                           F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
