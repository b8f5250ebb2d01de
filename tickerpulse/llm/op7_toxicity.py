"""Toxicity: cumulative-link ordinal regression on sparse text features.

A document's features are its different words and, for each, its first 4, 5
and 6 letters (inflected and newly coined forms share a stem). One weight
vector serves all thresholds: with ``s`` the sum of the weights of the
features present, ``P(grade >= k) = sigmoid(s - theta_k)`` for ordered
``theta``. The severity of a document is its expected grade.

The weights are non-negative with an L1 penalty: a clean passage never hides
a toxic one, however long the document is, and words with too little evidence
weigh exactly nothing.

**Fitting** uses at most ``per_class`` clean and ``per_class`` toxic labelled
rows (those with the smallest hash of their id) and the ``vocabulary``
features with the largest likelihood ratio for toxic text; both are
documented bounds. Feature counts are grouped by Spark; the driver holds the
vocabulary and the sample's counts of it. **Scoring** reads every whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain_words as words
from .common import stable_hash, stored, text_batches

PER_CLASS = 4000
VOCABULARY = 4000
STEMS = (4, 5, 6)
#: Words kept in a task's memo of word weights before it starts anew.
MEMO = 200_000
#: Different words of a text that count for one feature, in fitting and in scoring.
MOST = 3


def features(word: bytes) -> list[str]:
    """The word and, marked ``^``, its stems that are shorter than itself or equal to it."""
    w = word.decode("utf-8", "replace")
    return [w, *(f"^{w[:n]}" for n in STEMS if len(w) >= n)]


@dataclass(frozen=True)
class Ordinal:
    """A fitted model: non-zero feature weights and the ordered thresholds."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def above(self, score: np.ndarray) -> np.ndarray:
        """(rows, thresholds): probability of each grade or a higher one."""
        return _sigmoid(np.asarray(score, float)[:, None] - np.asarray(self.thresholds)[None, :])


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class _Memo(dict):
    """word -> its features that have a weight."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.of = weights

    def __missing__(self, word: bytes) -> tuple[str, ...]:
        if len(self) >= MEMO:
            self.clear()
        v = self[word] = tuple(f for f in features(word) if f in self.of)
        return v

    def score(self, text: str | None) -> float:
        """Summed weights of a text's features, each as often as different words have it, ``MOST`` times at most."""
        n: dict[str, int] = {}
        for w in set(words(text)):
            for f in self[w]:
                n[f] = n.get(f, 0) + 1
        return math.fsum(self.of[f] * min(c, MOST) for f, c in n.items())


def fit_weights(rows: list[tuple[list[int], list[int]]], grades: np.ndarray, size: int, *,
                l1: float = 0.0006, steps: int = 800) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by accelerated proximal gradient descent.

    ``rows`` holds (feature indices, counts) per document, ``grades`` integers
    from 0. With fewer than two grades the weights are zero.
    """
    top = int(grades.max()) if len(grades) else 0
    if top == 0 or (grades == grades[0]).all():
        return np.zeros(size), np.full(max(1, top), 6.0)
    n = len(grades)
    at = np.repeat(np.arange(n), [len(i) for i, _ in rows])
    col = np.concatenate([np.asarray(i, np.int64) for i, _ in rows]) if len(at) else np.empty(0, np.int64)
    val = np.minimum(np.concatenate([np.asarray(c, float) for _, c in rows]) if len(at) else np.empty(0), float(MOST))
    theta, w, idx = np.linspace(1.0, float(top), top), np.zeros(size), np.arange(n)
    d = np.ones(size)
    for _ in range(30):  # largest eigenvalue of the mean outer product, for the step
        d /= np.linalg.norm(d)
        d = np.bincount(col, (np.bincount(at, val * d[col], minlength=n))[at] * val, minlength=size) / n
    step = 1.0 / (0.5 * (float(np.linalg.norm(d)) + 1.0))
    vw, vt, t, before = w, theta, 1.0, np.inf
    for _ in range(steps):
        s = np.bincount(at, val * vw[col], minlength=n)
        p = _sigmoid(np.concatenate([np.full((n, 1), 80.0), s[:, None] - vt[None, :], np.full((n, 1), -80.0)], axis=1))
        dens, mass = p * (1 - p), np.maximum(p[idx, grades] - p[idx, grades + 1], 1e-12)
        d_s = -(dens[idx, grades] - dens[idx, grades + 1]) / mass / n
        d_t = np.array([(dens[grades == k, k] / mass[grades == k]).sum()
                        - (dens[grades == k - 1, k] / mass[grades == k - 1]).sum() for k in range(1, top + 1)]) / n
        loss = -np.log(mass).mean() + l1 * vw.sum()
        if loss > before:  # restart the momentum
            t = 1.0
        before = loss
        w2 = np.maximum(0.0, vw - step * (np.bincount(col, d_s[at] * val, minlength=size) + l1))
        th2 = np.maximum.accumulate(vt - step * d_t)
        t2 = 0.5 * (1 + np.sqrt(1 + 4 * t * t))
        vw = np.maximum(0.0, w2 + (t - 1) / t2 * (w2 - w))
        vt = np.maximum.accumulate(th2 + (t - 1) / t2 * (th2 - theta))
        w, theta, t = w2, th2, t2
    return w, theta


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id",
                    text: str = "text", label: str = "toxic") -> DataFrame:
    """(id, y, words) of at most ``per_class`` rows of each class, stored.

    Rows whose label or id is NULL do not count; an id labelled twice is toxic
    if one of its labels is; of texts that share an id the smallest is taken.
    """
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label).alias("y")).filter("id IS NOT NULL AND y IS NOT NULL")
              .groupBy("id").agg(F.max((F.col("y") > 0).cast("int")).alias("y")))
    chosen = None
    for y in (0, 1):
        part = marked.filter(F.col("y") == y).orderBy(stable_hash("id"), "id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    found = F.broadcast(stored(chosen, "toxicity-labels"))  # at most 2 * per_class rows of two numbers
    texts = (text_batches(docs).select(F.col(id_col).alias("id"), F.col(text).alias("t")).join(found, "id")
             .groupBy("id", "y").agg(F.min("t").alias("t")))

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ts in batches:
            yield pd.Series([sorted({w.decode("utf-8", "replace") for w in words(t)}) for t in ts])
    return stored(texts.select("id", "y", split("t").alias("words")), "toxicity-sample")


def _vocabulary(sample: DataFrame, size: int) -> list[tuple[str, int, int]]:
    """(feature, toxic documents, clean documents) of the strongest signs of toxic text."""
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return []
    word = F.col("w")
    stems = [F.when(F.length(word) >= k, F.concat(F.lit("^"), F.substring(word, 1, k))) for k in STEMS]
    each = (sample.select("id", "y", F.explode("words").alias("w"))
            .select("id", "y", F.explode(F.array(word, *stems)).alias("feature")).filter("feature IS NOT NULL").distinct())
    seen = (each.groupBy("feature").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean"))
            .filter("toxic + clean >= 3"))
    a, b = (F.col("toxic") + 0.5) / (n1 + 1.0), (F.col("clean") + 0.5) / (n0 + 1.0)
    mean = (F.col("toxic") + F.col("clean") + 1.0) / (n1 + n0 + 2.0)
    gain = F.col("toxic") * F.log(a / mean) + F.col("clean") * F.log(b / mean)
    rows = seen.filter(a > 2 * b).orderBy(F.desc(F.round(gain, 9)), "feature").limit(size).collect()  # at most `size` rows
    return [(r["feature"], r["toxic"], r["clean"]) for r in rows]


def severity_grades(marks: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Grades 1 to 3 for toxic rows, 0 for the rest, from 0/1 labels.

    Where labels only say toxic or not, severity is how many different marked
    words (words that toxic text has and clean text hardly has) a toxic
    document holds, cut at the terciles of the toxic rows.
    """
    if not (y == 1).any():
        return np.zeros(len(y), np.int64)
    cuts = np.quantile(marks[y == 1], [1 / 3, 2 / 3])
    return np.where(y == 1, 1 + (marks[:, None] > cuts[None, :]).sum(axis=1), 0).astype(np.int64)


def train(docs: DataFrame, labels: DataFrame, *, per_class: int = PER_CLASS, vocabulary: int = VOCABULARY,
          id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Ordinal:
    """Fit from a table of 0/1 labels. Without rows of both classes, a model that calls everything clean."""
    sample = labelled_sample(docs, labels, per_class, id_col, text, label)
    vocab = _vocabulary(sample, vocabulary)
    index = {f: i for i, (f, _, _) in enumerate(vocab)}
    if not index:
        return Ordinal({}, (6.0, 7.0, 8.0))
    marks = {f for f, toxic, clean in vocab if toxic >= 3 and toxic > 20 * clean}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for ws in b["words"]:
                got: dict[int, int] = {}
                marked = 0
                for w in ws:
                    fs = features(w.encode("utf-8", "replace"))
                    marked += any(f in marks for f in fs)
                    for f in fs:
                        if (i := index.get(f)) is not None:
                            got[i] = got.get(i, 0) + 1
                out.append((list(got), list(got.values()), marked))
            yield pd.DataFrame({"id": b["id"], "y": b["y"], "at": [o[0] for o in out], "n": [o[1] for o in out], "marked": [o[2] for o in out]})
    rows = sample.mapInPandas(count, "id long, y int, at array<int>, n array<int>, marked int").orderBy("id").collect()  # at most 2 * per_class
    y = np.array([r["y"] for r in rows], np.int64)
    grades = severity_grades(np.array([r["marked"] for r in rows], float), y)
    w, theta = fit_weights([(r["at"], r["n"]) for r in rows], grades, len(index))
    return Ordinal({f: float(w[i]) for f, i in index.items() if w[i] > 0}, tuple(float(x) for x in theta))


def score(docs: DataFrame, model: Ordinal, text: str = "text", cut: float = 0.5) -> DataFrame:
    """``docs`` with ``severity`` (expected grade), ``p_toxic``, ``grade`` (the
    highest that is at least as likely as not) and ``toxic`` (``p_toxic >= cut``).

    NULL and empty texts score as a text without features. Columns of those
    names that ``docs`` already has are replaced. Each row is scored alone, so
    repeated rows get equal results; an empty table gives an empty one.
    """
    weights, model_ = model.weights, model

    @F.pandas_udf("severity double, p_toxic double, grade int")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memo = _Memo(weights)
        for ts in batches:
            s = np.array([memo.score(t) for t in ts], float)
            p = model_.above(s).reshape(len(s), -1)
            yield pd.DataFrame({"severity": p.sum(axis=1), "p_toxic": p[:, 0], "grade": (p >= 0.5).sum(axis=1).astype(np.int32)})
    kept = [c for c in docs.columns if c not in ("severity", "p_toxic", "grade", "toxic", "_rated")]
    return (text_batches(docs).select(*kept, rate(F.col(text)).alias("_rated"))
            .select(*kept, "_rated.severity", "_rated.p_toxic", "_rated.grade", (F.col("_rated.p_toxic") >= cut).alias("toxic")))
