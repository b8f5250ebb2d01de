"""Ordinal toxicity regression: gradients, held-out accuracy, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerpulse.llm import op7_toxicity as T

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    return T.train(docs, labels.filter("doc_id % 4 <> 0"))


def test_held_out(spark, model):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = labels.filter("doc_id % 4 = 0").select("doc_id", F.col("toxic").alias("y"))
    rows = T.score(docs, model).join(held, "doc_id").collect()
    toxic, clean = [r for r in rows if r["y"] == 1], [r for r in rows if r["y"] == 0]
    assert sum(r["toxic"] for r in toxic) >= 0.7 * len(toxic) and len(toxic) > 5
    assert sum(r["toxic"] for r in clean) <= 0.02 * len(clean)
    assert np.mean([r["severity"] for r in toxic]) > 5 * np.mean([r["severity"] for r in clean])


def test_ordered_thresholds_recover_grades():
    rng = np.random.default_rng(3)
    rows, grades = [], []
    for _ in range(1500):
        n = rng.integers(0, 6, 4)
        s = 1.5 * min(n[0], 3) + 0.8 * min(n[1], 3)
        rows.append((list(range(4)), n.tolist()))
        grades.append(int(s + rng.logistic() > 2) + int(s + rng.logistic() > 4))
    w, theta = T.fit_weights(rows, np.array(grades), 4, l1=1e-4)
    assert w[0] > w[1] > 0.2 and w[2] < 0.15 and w[3] < 0.15
    assert 0 < theta[0] < theta[1]


def test_severity_grades():
    assert T.severity_grades(np.array([0, 9, 1, 2, 3.0]), np.array([0, 0, 1, 1, 1])).tolist() == [0, 0, 1, 2, 3]
    assert T.severity_grades(np.array([5.0]), np.array([0])).tolist() == [0]


def test_odd_rows(spark, model):
    rows = [(1, None, "a"), (2, "", "a"), (None, "you idiot scum", "a"), (3, "idiot moron clown trash worthless", "b"),
            (3, "idiot moron clown trash worthless", "b"), (4, "the and of " * 50000 + " idiot moron clown trash worthless", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, severity string").withColumn("toxic", F.lit(1))
    got = T.score(docs, model).collect()
    assert len(got) == 6 and docs.columns.index("text") == 1
    by = [(r["doc_id"], r["toxic"]) for r in got]
    assert by[:2] == [(1, False), (2, False)] and by[3:] == [(3, True), (3, True), (4, True)]
    assert got[3]["severity"] == got[4]["severity"] > got[0]["severity"]
    assert T.score(docs.limit(0), model).count() == 0


def test_no_or_odd_labels(spark):
    docs = spark.createDataFrame([(1, "idiot"), (None, "x"), (2, None), (2, "b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int, text string")
    assert not T.score(docs, T.train(docs, none)).filter("toxic").count()
    odd = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (2, 0), (9, 1)], "doc_id long, toxic int")
    assert T.score(docs, T.train(docs, odd)).count() == 4


def test_a_long_clean_text_on_one_stem(spark):
    """Scoring counts a stem as fitting does: of 500 different words that share it, three."""
    long = " ".join(f"tras{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(500))
    docs = spark.createDataFrame([(1, long), (2, "trasax trasbx trascx"), (3, "trasax trasbx")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in T.score(docs, T.Ordinal({"^tras": 1.0}, (4.0, 5.0, 6.0))).collect()}
    assert not got[1]["toxic"] and got[1]["severity"] == got[2]["severity"] > got[3]["severity"]
