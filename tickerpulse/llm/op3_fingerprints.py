"""Document fingerprints: weighted SimHash, and search by permuted block tables.

The terms of a text are its lower-cased words and its pairs of neighbouring
words. Each term's hash votes, with weight ``1 + ln(count)``, for or against
each of 256 bits by its sign there; a bit is set where the votes for it win.
Two fingerprints that differ in ``h`` bits belong to texts whose weighted
term vectors have a cosine of about ``cos(pi * h / 256)``.

**Search.** The bits are cut into 8 blocks. Fingerprints within ``radius``
bits, up to 7, agree in at least ``8 - radius`` blocks, so there is a table for
each choice of as many blocks, which brings those blocks to the front as its
key: all fingerprints in reach meet in some table. From 8 bits on they need not
agree in any block, but differ in at most ``radius // 8`` bits in some block;
there is a table for each block, and a query asks each for its block and all
values that differ from it in as many bits. A pair that meets in several
tables is counted in the first. Crowded keys are cut into chunks by a hash, and each
query goes to every chunk of its key; tasks return counts, never pairs.

**Next document.** Rows are range-partitioned by id, each task walks its rows
in order, and only the first and last row of each partition are matched
afterwards, so texts move once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stable_hash, stored, text_batches

LANES, BLOCKS = 4, 8
BITS = 64 * LANES
#: Bits of a block that a query may flip: radii up to 23 have 529 values a block.
MOST_FLIPS = 2
#: Members of one key that one task compares with the key's queries.
CHUNK = 2048
#: Rows of the tables that one task takes together.
GROUP = 60_000
MEMO = 500_000

_BYTE_SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little") * 2.0 - 1.0
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: str, memo: dict[bytes, int] | None = None) -> bytes:
    """32 bytes; all zero for a text without words."""
    words = text.lower().encode("utf-8", "replace").split()
    if not words:
        return bytes(BITS // 8)
    one = np.fromiter(map((_Hashes() if memo is None else memo).__getitem__, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        pairs = _mix(one[:-1] * np.uint64(3) + np.roll(one, -1)[:-1])
        terms, counts = np.unique(np.concatenate([one, pairs]), return_counts=True)
        lanes = _mix(terms[:, None] + _GOLDEN * np.arange(1, LANES + 1, dtype=np.uint64)[None, :])
    at = lanes.view(np.uint8).reshape(len(terms), 8 * LANES) + np.arange(8 * LANES, dtype=np.int64) * 256
    weight = np.repeat(1.0 + np.log(counts), 8 * LANES)
    votes = np.bincount(at.ravel(), weights=weight, minlength=8 * LANES * 256).reshape(8 * LANES, 256) @ _BYTE_SIGNS
    return np.packbits(votes.ravel() > 1e-9, bitorder="little").tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated cosine of the weighted term vectors, 0 to 1."""
    h = int.from_bytes(a, "little") ^ int.from_bytes(b, "little")
    return max(0.0, float(np.cos(np.pi * h.bit_count() / BITS)))


def edited_text(text: str, following: str) -> str:
    """The last half of ``text`` (rounded down) replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


# ---- fingerprints of all documents, their edits and neighbours ---------------

_ROWS = ("part int, role string, id {id}, n_chars long, fp binary, edited_fp binary, edited_sha256 string, "
         "next_fp binary, text string")


def _finish(part, id_, text: str, fp: bytes, following: str, next_fp: bytes, memo) -> tuple:
    edited = edited_text(text, following)
    return (part, "row", id_, len(text), fp, fingerprint(edited, memo),
            hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), next_fp, None)


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo, held = _Hashes(), None
    for b in batches:
        rows = []
        for part, id_, text in zip(b["part"].tolist(), b["id"].tolist(), b["t"]):
            fp = fingerprint(text, memo)
            if held is None:
                rows.append((part, "first", id_, len(text), fp, None, None, None, text))
            else:
                rows.append(_finish(*held, text, fp, memo))
            held = (part, id_, text, fp)
        yield _frame(rows)
    if held is not None:
        part, id_, text, fp = held
        yield _frame([(part, "last", id_, len(text), fp, None, None, None, text)])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["part", "role", "id", "n_chars", "fp", "edited_fp", "edited_sha256", "next_fp", "text"])
    return out.assign(id=pd.array([r[2] for r in rows], dtype=object))


def _meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        memo = _Hashes()
        yield _frame([_finish(*r, memo) for r in zip(b["part"], b["id"].tolist(), b["text"], map(bytes, b["fp"]), b["following"], map(bytes, b["follow_fp"]))])


def with_neighbours(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, fp, edited_fp, edited_sha256, next_fp) of every row, stored.

    The next document is the one of the next id (NULL ids last, equal ids by a
    hash of the text); after the last comes the first, a single row follows
    itself. A NULL text counts as empty.
    """
    spark = docs.sparkSession
    rows = text_batches(docs).select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    order = [F.col("id").asc_nulls_last(), F.xxhash64("t"), F.col("id").isNull()]
    laid = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order[:2])
    schema = _ROWS.format(id=dict(rows.dtypes)["id"])
    done = stored(laid.withColumn("part", F.spark_partition_id()).mapInPandas(_walk, schema), "fingerprints")
    edges = done.filter("role <> 'row'")
    parts = sorted(r["part"] for r in edges.filter("role = 'first'").select("part").collect())  # one number a partition
    out = done.filter("role = 'row'")
    if parts:
        follow = F.broadcast(spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int"))
        firsts = edges.filter("role = 'first'").select(F.col("part").alias("next"), F.col("text").alias("following"), F.col("fp").alias("follow_fp"))
        met = (edges.filter("role = 'last'").join(follow, "part").join(firsts, "next")
               .select("part", "id", "text", "fp", "following", "follow_fp").mapInPandas(_meet, schema))
        out = out.unionByName(stored(met, "fingerprints-edges"))
    return out.select("id", "n_chars", "fp", "edited_fp", "edited_sha256", "next_fp")


# ---- permuted block tables ------------------------------------------------

def tables(radius: int) -> list[tuple[int, ...]]:
    """The blocks each table brings to the front."""
    if not 0 <= radius < (MOST_FLIPS + 1) * BLOCKS:
        raise ValueError(f"the radius must lie between 0 and {(MOST_FLIPS + 1) * BLOCKS - 1} bits")
    return list(combinations(range(BLOCKS), max(1, BLOCKS - radius)))


def _keys(fps: DataFrame, radius: int) -> DataFrame:
    """A row per table: ``tab`` and ``front`` (its leading block itself, or the hash of several)."""
    width = BITS // 8 // BLOCKS

    def front(blocks: tuple[int, ...]):
        parts = [F.substring("fp", b * width + 1, width) for b in blocks]
        return F.xxhash64(*parts) if len(parts) > 1 else F.conv(F.hex(parts[0]), 16, 10).cast("long")
    return fps.select("*", F.posexplode(F.array(*map(front, tables(radius)))).alias("tab", "front"))


def _probes(fps: DataFrame, radius: int) -> DataFrame:
    """The rows of ``_keys``, and one for each ``front`` that differs in at most ``radius // 8`` bits."""
    flips = [sum(1 << b for b in bits) for n in range(radius // BLOCKS + 1) for bits in combinations(range(BITS // BLOCKS), n)]
    masks = F.array(*[F.lit(m).cast("long") for m in flips])
    return _keys(fps, radius).withColumn("front", F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("front")))))


def _count_matches(radius: int):
    chosen, flips = [np.array(t) for t in tables(radius)], radius // BLOCKS

    def match(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out_fp, out_n = [], []
        if len(members) and len(queries):
            by = members.groupby(["tab", "front", "chunk"], sort=False).indices
            m_bits = np.frombuffer(b"".join(map(bytes, members["fp"])), np.uint32).reshape(-1, BLOCKS)
            q_bits = np.frombuffer(b"".join(map(bytes, queries["fp"])), np.uint32).reshape(-1, BLOCKS)
            copies = members["copies"].to_numpy()
            for key, qs in queries.groupby(["tab", "front", "chunk"], sort=False).indices.items():
                ms = by.get(key)
                if ms is None:
                    continue
                for at in range(0, len(qs), 64):
                    some = qs[at:at + 64]
                    x = q_bits[some][:, None, :] ^ m_bits[ms][None, :, :]
                    bits = np.bitwise_count(x)
                    near = bits.sum(axis=2) <= radius
                    meets = bits <= flips
                    near &= meets[:, :, chosen[key[0]]].all(axis=2)  # not a chance collision of the key's hash
                    for t in range(key[0]):
                        near &= ~meets[:, :, chosen[t]].all(axis=2)
                    n = near @ copies[ms]
                    hit = np.flatnonzero(n)
                    out_fp += [bytes(queries["fp"].iat[some[i]]) for i in hit]
                    out_n += n[hit].tolist()
        return pd.DataFrame({"fp": pd.Series(out_fp, dtype=object), "n": pd.Series(out_n, dtype="int64")})
    return match


def within(fps: DataFrame, queries: DataFrame, radius: int = 7) -> DataFrame:
    """(fp, n) for each different ``fp`` of ``queries``: how many rows of ``fps`` lie within ``radius`` bits.

    Both tables have a binary column ``fp`` of 32 bytes. Equal fingerprints of
    either side are taken together, with their number.
    """
    members = _keys(fps.groupBy("fp").agg(F.count("*").alias("copies")), radius)
    asked = _probes(stored(queries.select("fp").distinct(), "tables-queries"), radius)
    wanted = asked.select("tab", "front").distinct()
    kept = stored(members.join(wanted.hint("merge"), ["tab", "front"], "left_semi"), "tables-members")  # the keys grow with the queries
    sizes = kept.groupBy("tab", "front").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    total = kept.count()
    sizes = stored(sizes, "tables-sizes").hint("merge")  # by its file Spark takes ``asked`` for small, and would broadcast every value asked for
    groups = -(-max(1, total) // GROUP) * 4
    place = F.pmod(stable_hash("tab", "front", "chunk"), F.lit(groups)).alias("group")
    dealt = (kept.join(sizes, ["tab", "front"]).withColumn("chunk", F.pmod(stable_hash("fp"), F.col("chunks")).cast("int"))
             .select(place, "tab", "front", "chunk", "fp", "copies"))
    sent = (asked.join(sizes, ["tab", "front"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select(place, "tab", "front", "chunk", "fp"))
    counted = dealt.groupBy("group").cogroup(sent.groupBy("group")).applyInPandas(_count_matches(radius), "fp binary, n long")
    return counted.groupBy("fp").agg(F.sum("n").alias("n"))


def report(docs: DataFrame, queries, radius: int = 7, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint (64 hex digits),
    near_edited, near_next, and for rows that ``queries`` (a condition on the id) picks ``n_within``: the
    number of documents, itself included, within ``radius`` bits.

    Repeated rows stay repeated; an empty table gives an empty one; extra columns are not read.
    """
    found = with_neighbours(docs, id_col, text)
    asked = found.filter(queries(F.col("id")))
    near = stored(within(found.select("fp"), asked.select("fp"), radius), "fingerprints-near")

    @F.pandas_udf("near_edited double, near_next double")
    def alike(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for fp, edited, following in batches:
            a, b, c = (np.frombuffer(b"".join(map(bytes, x)), np.uint64).reshape(-1, LANES) for x in (fp, edited, following))
            yield pd.DataFrame({n: np.maximum(0.0, np.cos(np.pi * np.bitwise_count(a ^ x).sum(axis=1) / BITS))
                                for n, x in (("near_edited", b), ("near_next", c))})
    near = near.select(F.col("fp").alias("_fp"), "n")
    counted = found.join(near, queries(F.col("id")) & (F.col("fp") == F.col("_fp")), "left")
    return (counted.withColumn("a", alike("fp", "edited_fp", "next_fp"))
            .select(F.col("id").alias(id_col), "n_chars", "edited_sha256", F.lower(F.hex("fp")).alias("fingerprint"),
                    F.lower(F.hex("edited_fp")).alias("edited_fingerprint"), "a.near_edited", "a.near_next", F.col("n").alias("n_within")))
