"""Product quantisation of vectors, with norm-of-sum bounds that spare distances.

Components become integers, floor(scale * x), so every distance and every sum
is exact and reruns agree. A vector is cut into parts; each part position has a
codebook that starts as those parts of the vectors with the smallest ids and
is refined by rounds of assignment and averaging.

**Bounds.** The entries of a codebook are grouped once by nearness. For each
part a vector keeps the distance to the nearest entry of each group, and the
round in which it was measured. All codebooks of all rounds are retained, so
in a later round the distance can have shrunk by at most the *net*
displacement, the norm of the summed moves, of the group's entries since that
round: ``bound - max |c_now - c_then|``. That is never more than the sum of
the moves' norms that accumulated drifts subtract. A group is scanned again,
exactly, only if its bound does not exceed the distance to the best entry met
so far; ties are scanned, so the lower index wins as without bounds. Bounds
are rounded towards scanning.

Every round is a map over the vectors and their bounds, without a shuffle; a
second pass sums the parts of each entry per task, and a row for each entry
and place reaches the driver. Both the codebooks and their history are as
large as the model, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, stored

#: Largest integer component: squares of differences, summed, stay exact in 64 bits.
LARGEST = 1 << 28
#: Groups of entries that share a bound.
GROUPS = 16
#: Below this size, float64 products of integers are exact.
_FLOAT_EXACT = 1 << 22


@dataclass
class Codebooks:
    """One codebook per part position (entries x places), its groups, and the history of all rounds."""
    entries: list[np.ndarray]
    groups: list[np.ndarray]
    history: list[list[np.ndarray]] = field(default_factory=list)

    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(x) for e in self.entries for x in e.ravel().tolist()).encode()).hexdigest()


def integers(vectors: DataFrame, vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """``vectors`` with ``v``, the integers floor(scale * x); rows whose vector is
    NULL or holds a NULL or non-finite component are dropped."""
    number = F.col(vector).cast("array<double>")
    whole = ~F.exists(number, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(F.col(vector).isNotNull()).filter(whole).withColumn("v", F.transform(number, lambda x: F.floor(x * scale)))


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack(values.to_list()).astype(np.int64, copy=False) if len(values) else np.empty((0, 0), np.int64)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to integer entries."""
    if not entries.shape[1]:
        return np.zeros((len(x), len(entries)), np.int64)
    if max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)) < _FLOAT_EXACT and x.shape[1] <= 256:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for d in range(x.shape[1]):
        gap = x[:, d, None] - entries[None, :, d]
        out += gap * gap
    return out


def grouped(entries: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """A group number for each entry, near entries together: farthest seeds, then the nearest seed."""
    if not len(entries):
        return np.empty(0, np.int64)
    seeds = [0]
    gap = squared(entries, entries[:1])[:, 0]
    while len(seeds) < min(groups, len(entries)) and gap.max() > 0:
        seeds.append(int(gap.argmax()))
        gap = np.minimum(gap, squared(entries, entries[seeds[-1:]])[:, 0])
    return squared(entries, entries[seeds]).argmin(axis=1)


def _net_moves(books: Codebooks, part: int) -> np.ndarray:
    """(round, group): how far an entry of the group has moved from that round until now, at most."""
    now, group = books.entries[part], books.groups[part]
    out = np.zeros((len(books.history), group.max(initial=-1) + 1))
    for r, then in enumerate(books.history):
        gap = (now - then[part]).astype(np.float64)
        np.maximum.at(out[r], group, np.sqrt((gap * gap).sum(axis=1)))
    return out * (1 + 1e-12)


def assign(x: np.ndarray, books: Codebooks, part: int, turn: int, kept: tuple | None) -> tuple:
    """Nearest entries of the part's rows ``x`` in round ``turn`` and the state for later rounds.

    ``kept`` is the state of an earlier round: (entry, bounds, stamps). Returns
    (entry, bounds, stamps, squared distance, distances measured); ``bounds`` are
    float32 lower bounds on the distance to every entry of a group, exact up to rounding in round ``stamps``.
    """
    entries, group = books.entries[part], books.groups[part]
    n, many = len(x), group.max(initial=-1) + 1
    if kept is None:
        best = np.zeros(n, np.int64)
        bounds, stamps = np.zeros((n, many), np.float32), np.full((n, many), turn, np.uint8)
        low = np.full((n, many), -1.0)
    else:
        best, bounds, stamps = kept[0].astype(np.int64), kept[1].copy(), kept[2].copy()
        moves = _net_moves(books, part)
        low = bounds.astype(np.float64) - moves[stamps, np.arange(many)[None]]
    gap = x - entries[best]
    error = np.zeros(n, np.int64)
    for d in range(x.shape[1]):
        error += gap[:, d] * gap[:, d]
    measured = np.ones(n, np.int64)
    for g in range(many):
        scan = np.flatnonzero(low[:, g] <= np.sqrt(error.astype(np.float64)) * (1 + 1e-12))
        if not len(scan):
            continue
        of = np.flatnonzero(group == g)
        gaps = squared(x[scan], entries[of])
        measured[scan] += len(of)
        first = gaps.argmin(axis=1)  # entries of a group are in ascending order, so ties go to the lower index
        least, at = gaps[np.arange(len(scan)), first], of[first]
        better = (least < error[scan]) | ((least == error[scan]) & (at < best[scan]))
        best[scan[better]], error[scan[better]] = at[better], least[better]
        bounds[scan, g] = np.nextafter(np.sqrt(least.astype(np.float64)).astype(np.float32), np.float32(-1))
        stamps[scan, g] = turn
    return best, bounds, stamps, error, measured


def _round(rows: DataFrame, books: Codebooks, turn: int) -> DataFrame:
    """``rows`` (id, label, v and, after the first round, the state) with the state of this round."""
    parts = len(books.entries)
    edges = np.cumsum([0, *(int(g.max(initial=-1)) + 1 for g in books.groups)])

    def joined(arrays: list[np.ndarray], n: int) -> pd.Series:
        return pd.Series([row.tobytes() for row in np.concatenate([a.reshape(n, -1) for a in arrays], axis=1)], dtype=object)

    def step(v: pd.Series, old: list | None, measured: np.ndarray) -> pd.DataFrame:
        x, n = _matrix(v), len(v)
        width = x.shape[1] // parts
        got = [assign(x[:, p * width:(p + 1) * width], books, p, turn, old[p] if old else None) for p in range(parts)]
        return pd.DataFrame({"code": joined([g[0].astype(np.uint8) for g in got], n), "bounds": joined([g[1] for g in got], n),
                             "stamps": joined([g[2] for g in got], n), "error": sum(g[3] for g in got),
                             "measured": measured + sum(g[4] for g in got)})

    kind = "code binary, bounds binary, stamps binary, error long, measured long"

    @F.pandas_udf(kind)
    def first(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for v in batches:
            yield step(v, None, np.zeros(len(v), np.int64))

    @F.pandas_udf(kind)
    def later(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for v, code, bounds, stamps, measured in batches:
            n = len(v)
            codes = np.frombuffer(b"".join(code), np.uint8).reshape(n, parts)
            low = np.frombuffer(b"".join(bounds), np.float32).reshape(n, edges[-1])
            seen = np.frombuffer(b"".join(stamps), np.uint8).reshape(n, edges[-1])
            old = [(codes[:, p], low[:, edges[p]:edges[p + 1]], seen[:, edges[p]:edges[p + 1]]) for p in range(parts)]
            yield step(v, old, measured.to_numpy())
    # ids and labels stay in the JVM: pandas would turn integers beside NULLs into floats
    state = first("v") if turn == 0 else later("v", "code", "bounds", "stamps", "measured")
    return rows.select("id", "label", "v", state.alias("s")).select("id", "label", "v", "s.*")


def _moved(rows: DataFrame, entries: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after averaging: floor(sum / count) of each entry's parts; unused entries stay."""
    parts = len(entries)
    many, width = entries[0].shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, counts = np.zeros((parts, many, width), np.int64), np.zeros((parts, many), np.int64)
        for frame in batches:
            if not len(frame):
                continue
            x = _matrix(frame["v"]).reshape(len(frame), parts, width)
            code = np.frombuffer(b"".join(frame["code"]), np.uint8).reshape(len(frame), parts)
            for p in range(parts):
                counts[p] += np.bincount(code[:, p], minlength=many)
                order = np.argsort(code[:, p], kind="stable")
                begins = np.flatnonzero(np.diff(code[order, p].astype(np.int64), prepend=-1))
                sums[p, code[order[begins], p]] += np.add.reduceat(x[order, p], begins, axis=0)
        part, entry = np.nonzero(counts)
        held = sums[part, entry]
        yield pd.DataFrame({"part": np.repeat(part, width + 1), "entry": np.repeat(entry, width + 1),
                            "place": np.tile(np.arange(-1, width), len(part)),
                            "s": np.concatenate([counts[part, entry][:, None], held], axis=1).ravel()})
    # a row for each entry and place and task, summed map-side and again: the result is as large as the codebooks
    rows_ = (rows.select("v", "code").mapInPandas(run, "part long, entry long, place long, s long")
             .groupBy("part", "entry", "place").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    total = {(r["part"], r["entry"], r["place"]): int(r["s"]) for r in rows_}
    out = [e.copy() for e in entries]
    for (p, e, place), s in total.items():
        if place >= 0:
            out[p][e, place] = s // total[p, e, -1]
    return out


def encode(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4,
           size: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, Codebooks]:
    """(id, label, code, error, measured) of each kept vector and the final codebooks.

    ``code`` holds one byte a part, ``error`` the squared distances summed over
    parts, ``measured`` how many distances were computed in all rounds.

    Vectors that are NULL or hold a NULL or non-finite component are dropped.
    NULL ids are kept and come last among those that start the codebooks;
    equal ids are ordered by their vectors. With fewer than ``size`` vectors
    the codebooks have an entry for each. All vectors must have one length, a
    multiple of ``parts``, and integers up to 2^28, else a ValueError says so;
    vectors of length 0 have error 0 and entry 0. Extra columns are not read. An
    empty table gives no rows and empty codebooks.
    """
    if not 0 < size <= 256 or not 0 <= rounds < 256:
        raise ValueError("indexes and rounds fit one byte each")
    rows = stored(integers(vectors, vector, scale).select(F.col(id_col).alias("id"), F.col(label).alias("label"), "v"), "codes-vectors")
    most = F.coalesce(F.array_max(F.transform("v", lambda x: F.abs(x))), F.lit(0))
    seen = rows.agg(F.min(F.size("v")).alias("lo"), F.max(F.size("v")).alias("hi"), F.max(most).alias("most")).first()
    if seen["lo"] is None:
        return rows.select("id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("measured")), Codebooks([np.empty((0, 0), np.int64)] * parts, [])
    if seen["lo"] != seen["hi"] or seen["lo"] % parts:
        raise ValueError(f"vectors of {seen['lo']} to {seen['hi']} components cannot be cut into {parts} equal parts")
    if seen["most"] > LARGEST:
        raise ValueError(f"a component of {seen['most']} is beyond {LARGEST}")
    first = _matrix(pd.Series([r["v"] for r in rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(size).collect()]))
    first = first.reshape(len(first), -1)
    width = first.shape[1] // parts
    entries = [first[:, p * width:(p + 1) * width].copy() for p in range(parts)]
    books = Codebooks(entries, [grouped(e) for e in entries])
    for turn in range(rounds + 1):
        books.history.append(books.entries)
        before, rows = rows, stored(_round(rows, books, turn), "codes-round")
        forget(before)  # nothing reads it again: the new table holds the vectors too
        if turn < rounds:
            books.entries = _moved(rows, books.entries)
    return rows.select("id", "label", "code", "error", "measured"), books


def report(vectors: DataFrame, id_col: str = "vec_id", **options) -> DataFrame:
    """Per kept vector: its id, ``code`` in hex, ``error``, ``label_error`` (summed over
    equal labels, NULLs together) and ``codebooks_sha256``."""
    coded, books = encode(vectors, id_col, **options)
    sums = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels")
    joined = coded.join(sums.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of")))
    return joined.select(F.col("id").alias(id_col), F.lower(F.hex("code")).alias("code"), "error", "label_error",
                         F.lit(books.sha256()).alias("codebooks_sha256"), "measured")
