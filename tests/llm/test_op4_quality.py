"""Quality posteriors: held-out accuracy, shrinkage against a plain version, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerpulse.llm import op4_quality as Q

SF = "/root/testdata/sf0.01"


def test_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = Q.assess(docs, labels.filter("doc_id % 2 <> 0")).join(labels.filter("doc_id % 2 = 0").select("doc_id", F.col("quality").alias("y")), "doc_id").collect()
    good, bad = [r for r in got if r["y"] == 1], [r for r in got if r["y"] == 0]
    assert sum(r["keep"] for r in good) >= 0.97 * len(good)
    assert sum(not r["keep"] for r in bad) >= 0.8 * len(bad) and len(bad) > 8


def test_classifier_recovers_a_law():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    y = (rng.random(3000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1])))).astype(float)
    m = Q.fit(x, y)
    assert m.weights[0] == pytest.approx(2.0, abs=0.3) and m.weights[1] == pytest.approx(-1.0, abs=0.3) and abs(m.weights[2]) < 0.2


def test_shrinkage_against_a_plain_version(spark):
    """Without a classifier the posterior is the left-out, twice shrunk share of the labels."""
    rng = np.random.default_rng(1)
    rows, marks = [], []
    for h, (rate, n) in enumerate([(0.9, 200), (0.2, 150), (0.6, 3), (0.5, 1), (0.8, 90)]):
        for i in range(n):
            d = len(rows)
            rows.append((d, "t", f"h{h}" if h != 3 else None, "en" if i % 3 else None))
            marks.append((d, int(rng.random() < rate)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r["doc_id"]: r for r in Q.assess(docs, spark.createDataFrame(marks, "doc_id long, quality int")).collect()}
    y = dict(marks)
    # every text is equal: the classifier knows nothing
    assert all(abs(r["evidence"]) < 0.02 for r in got.values())
    mu = sum(y.values()) / len(y)

    def groups(key):
        out = {}
        for d, _, s, lang in rows:
            n, g = out.get(key(s, lang), (0, 0))
            out[key(s, lang)] = (n + 1, g + y[d])
        return out

    def strength(g, rate):
        spread = sum(n * (k / n - rate[i]) ** 2 for i, (n, k) in g.items())
        noise = sum(rate[i] * (1 - rate[i]) for i in g)
        total = sum(n for n, _ in g.values())
        within = sum(n * rate[i] * (1 - rate[i]) for i, (n, _) in g.items()) / total
        b = (spread - noise) / total
        return min(1e4, max(1.0, within / b - 1)) if b > 0 else 1e4
    hosts, paths = groups(lambda s, lang: s), groups(lambda s, lang: (s, lang))
    mh = strength(hosts, {h: mu for h in hosts})
    post = {h: (k + mu * mh) / (n + mh) for h, (n, k) in hosts.items()}
    mp = strength(paths, {p: post[p[0]] for p in paths})
    for d, _, s, lang in rows:
        n, k = hosts[s]
        host = (k - y[d] + mu * mh) / (n - 1 + mh)
        n, k = paths[(s, lang)]
        path = (k - y[d] + host * mp) / (n - 1 + mp)
        assert got[d]["host_posterior"] == pytest.approx(host) and got[d]["path_posterior"] == pytest.approx(path)
        assert got[d]["quality"] == pytest.approx(path, abs=0.01)
    assert got[353]["host_posterior"] == pytest.approx(mu, abs=0.2)  # the only document of its host follows the world


def test_odd_rows(spark):
    rows = [(1, None, "a", "en"), (2, "", None, None), (None, "some good words here", "a", "en"), (3, "### *** %%%", "b", None),
            (3, "### *** %%%", "b", None), (4, "long words " * 50000, "b", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("y", F.lit("clash")).withColumn("n", F.lit(1))
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = Q.assess(docs, none).collect()
    assert len(got) == 6 and all(r["quality"] == pytest.approx(0.5, abs=0.01) for r in got)
    marks = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None), (4, 1), (99, 0)], "doc_id long, quality int")
    got = Q.assess(docs, marks).collect()
    assert len(got) == 6 and all(0 < r["quality"] < 1 for r in got)
    assert Q.assess(docs.limit(0), marks).count() == 0
