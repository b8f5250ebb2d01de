"""Quality: document evidence combined with host and path posteriors by empirical Bayes.

A logistic classifier on the form of a text (character classes, repeated
lines and words, word lengths) gives each document a log-likelihood ratio for
good against bad. Sites give the prior: the share of good documents of a
*host* (here the source) is shrunk towards the global share, and that of a
*path* (here source and language) towards its host's posterior. How far is
estimated from the data: the beta prior's strength is the one whose spread
matches how much hosts (and paths within hosts) really differ, so a sparse
site follows its parent and a large one its own documents. A document that is
labelled counts with its label, any other with the classifier's probability,
and never for its own prior.

All site figures are grouped sums with map-side combine; the driver sees a
few global sums. Bound of the training sample (documented parameter): at most
``per_class`` good and as many bad labelled rows, those with the smallest
hash of their id.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stable_hash, stored, text_batches

PER_CLASS = 4000
_LETTERS = bytes(c for c in range(256) if chr(c).isalpha() and c < 128 or c >= 128)
_DIGITS, _SPACE = b"0123456789", b" \t\n\r\x0b\x0c"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MILD = b".,;:!?'\"()-"
N_FEATURES = 12


def describe(text: str | None) -> np.ndarray:
    """Features of the form of a text; zeros for NULL and empty texts."""
    data = (text or "").encode("utf-8", "replace")
    n = len(data)
    if not n:
        return np.zeros(N_FEATURES)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    letters, digits, space = (n - len(data.translate(None, s)) for s in (_LETTERS, _DIGITS, _SPACE))
    upper, mild = (n - len(data.translate(None, s)) for s in (_UPPER, _MILD))
    symbols = n - letters - digits - space - mild
    counts = Counter(words)
    k = max(1, len(words))
    odd = sum(c for w, c in counts.items() if not w.strip(_MILD).isalpha() and w.isascii())
    return np.array([np.log1p(len(words)), letters / n, digits / n, space / n, upper / n, mild / n, symbols / n,
                     np.log1p(min(200.0, (n - space) / k)), len(counts) / k, max(counts.values(), default=0) / k,
                     1 - len(set(lines)) / max(1, len(lines)), odd / k])


@dataclass(frozen=True)
class Classifier:
    """Standardised logistic regression; ``prior`` is the log-odds of its training sample."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio of good against bad."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.clip(np.hstack([z, z * z, np.ones((len(z), 1))]) @ self.weights - self.prior, -12, 12)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Classifier:
    """Newton's method on the ridge-penalised likelihood, linear and squared terms."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    a = np.hstack([z, z * z, np.ones((len(z), 1))])
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (y - p) - penalty * w
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(h, g)
        w = w + step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return Classifier(mean, scale, w, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))


def train(docs: DataFrame, marks: DataFrame, per_class: int = PER_CLASS) -> Classifier | None:
    """From ``docs`` (id, text) and ``marks`` (id, y in 0 and 1, each id once); None without both classes."""
    chosen = None
    for y in (0, 1):
        part = marks.filter(F.col("y") == y).orderBy(stable_hash("id"), "id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = F.broadcast(stored(chosen, "quality-labels"))  # at most 2 * per_class rows of two numbers
    texts = docs.join(chosen, "id").groupBy("id", "y").agg(F.min("text").alias("text"))
    rows = texts.select("id", "y", _describe()("text").alias("x")).orderBy("id").collect()  # 2 * per_class rows of N_FEATURES numbers
    y = np.array([r["y"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return None
    return fit(np.array([r["x"] for r in rows], float), y)


def _describe():
    @F.pandas_udf("array<double>")
    def forms(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ts in batches:
            yield pd.Series([describe(t) for t in ts])
    return forms


def _strength(groups: DataFrame, rate) -> float:
    """How many documents the prior of a group counts for: ``mean (1 - mean) / variance - 1``
    for the variance between groups by the method of moments, between 1 and 10,000.

    ``groups`` has ``n`` and ``good``; ``rate`` is the column they are shrunk to.
    """
    n, own = F.col("n"), F.col("good") / F.col("n")
    row = groups.filter("n > 0").agg(
        F.sum(n * (own - rate) * (own - rate)).alias("spread"), F.sum(rate * (1 - rate)).alias("noise"), F.sum(n).alias("total"),
        F.sum(n * rate * (1 - rate)).alias("within")).first()
    if not row["total"]:
        return 10_000.0
    between = (row["spread"] - row["noise"]) / row["total"]
    mean = row["within"] / row["total"]
    return float(min(10_000.0, max(1.0, mean / between - 1))) if between > 0 else 10_000.0


def assess(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", host: str = "source",
           path: tuple[str, ...] = ("source", "lang"), label: str = "quality", per_class: int = PER_CLASS, cut: float = 0.5) -> DataFrame:
    """One row per document: id, evidence, host_posterior, path_posterior, quality (posterior probability), keep.

    NULL hosts and paths are sites like any other. Labels that are NULL or lack an id do not
    count, of several labels of an id the smallest does. Without labels of both classes the evidence is 0 everywhere
    and the prior decides (one half without any label). Repeated rows stay repeated; an empty table gives an empty one.
    """
    marks = (labels.select(F.col(id_col).alias("id"), F.col(label).alias("y")).filter("id IS NOT NULL AND y IS NOT NULL")
             .groupBy("id").agg(F.min((F.col("y") > 0).cast("int")).alias("y")))
    rows = text_batches(docs).select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.col(host).alias("host"), F.struct(*[F.col(c) for c in path]).alias("path"))
    model = train(rows.select("id", "text"), marks, per_class)
    if model is None:
        scored = rows.select("id", "host", "path", F.lit(0.0).alias("evidence"))
    else:
        @F.pandas_udf("double")
        def evidence(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for ts in batches:
                yield pd.Series(model.evidence(np.array([describe(t) for t in ts]).reshape(-1, N_FEATURES)))
        scored = rows.select("id", "host", "path", evidence("text").alias("evidence"))
    total = marks.agg(F.count("*").alias("n"), F.sum("y").alias("good")).first()
    overall = ((total["good"] or 0) + 0.5) / (total["n"] + 1.0)
    odds = float(np.log(overall / (1 - overall)))
    soft = 1 / (1 + F.exp(-(F.col("evidence") + F.lit(odds))))
    scored = stored(scored.join(marks.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left")
                    .select("id", "host", "path", "evidence", F.coalesce(F.col("y").cast("double"), soft).alias("y")), "quality-scored")
    sums = [F.count("*").alias("n"), F.sum("y").alias("good")]
    paths = stored(scored.groupBy("host", "path").agg(*sums), "quality-paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "quality-hosts")
    world = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    mu = float(np.clip((world["good"] or 0.0) / world["n"], 1e-3, 1 - 1e-3)) if world["n"] else 0.5
    m_host = _strength(hosts, F.lit(mu))

    def shrunk(good, n, to, m):
        return (good + to * m) / (n + m)
    named = hosts.select(F.col("host").alias("_h"), F.col("n").alias("h_n"), F.col("good").alias("h_good"))
    both = paths.join(named, F.col("host").eqNullSafe(F.col("_h")))
    m_path = _strength(both, shrunk(F.col("h_good"), F.col("h_n"), F.lit(mu), F.lit(m_host)))
    sites = stored(both.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "n", "good", "h_n", "h_good"), "quality-sites")
    own = F.col("y")  # left out of its own prior
    joined = scored.join(sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
    host_posterior = shrunk(F.col("h_good") - own, F.col("h_n") - 1, F.lit(mu), F.lit(m_host))
    out = joined.withColumn("host_posterior", host_posterior)
    out = out.withColumn("path_posterior", F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), shrunk(F.col("good") - own, F.col("n") - 1, F.col("host_posterior"), F.lit(m_path)))))
    quality = 1 / (1 + F.exp(-(F.col("evidence") + F.log(F.col("path_posterior") / (1 - F.col("path_posterior"))))))
    return (out.withColumn("quality", quality)
            .select(F.col("id").alias(id_col), "evidence", "host_posterior", "path_posterior", "quality", (F.col("quality") >= cut).alias("keep")))
