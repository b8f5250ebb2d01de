"""Base patterns against plain re; gradients of the tagger; held-out accuracy; odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerpulse.llm import bilstm_crf as B
from tickerpulse.llm import op9_pii as P

SF = "/root/testdata/sf0.01"


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def brute(text):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], P.KINDS.index(s[2]), s[1]))


def test_base_spans_equal_plain_patterns():
    rng = random.Random(1)
    parts = ["a", "b", "Z", "@", ".", "-", "+", " ", "1", "2", "0", "9", "255", "(", ")", "%", "é", "\n", "٣",
             "4111 1111 1111 1111", "a@b.co", "10.0.0.1", "+49 30 1234567"]
    for _ in range(20000):
        s = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert P.base_spans(s) == brute(s), s
    for s in ("a" * 200000 + "@", "1" * 200000, "1." * 50000, "@" * 50000, "+1" * 50000):  # no quadratic time
        P.base_spans(s)


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in B._init(7, 3, 4, 5, rng).items()}
    B.F4, old = np.float64, B.F4
    try:
        x, y = rng.integers(0, 7, (6, 3)), rng.integers(0, 3, (6, 3))
        _, g = B._loss_and_grads(p, x, y)
        for name in p:
            for _ in range(3):
                at = tuple(rng.integers(0, n) for n in p[name].shape)
                keep, eps = p[name][at], 1e-5
                p[name][at] = keep + eps
                up = B._loss_and_grads(p, x, y)[0]
                p[name][at] = keep - eps
                down = B._loss_and_grads(p, x, y)[0]
                p[name][at] = keep
                assert abs((up - down) / (2 * eps) - g[name][at]) < 1e-5, name
    finally:
        B.F4 = old


@pytest.fixture(scope="module")
def model(spark):
    return P.train(spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id % 4 <> 0"))


def test_held_out_and_report(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    held = [r["text"] for r in rows if r["doc_id"] % 4 == 0]
    want = [set(brute(t)) for t in held]
    got = [set(s) for s in P.added_spans(held, [[]] * len(held), model, 0.0)]
    hit, n, found = sum(len(a & b) for a, b in zip(want, got)), sum(map(len, want)), sum(map(len, got))
    assert n > 10 and hit >= 0.7 * n and hit >= 0.7 * found
    out = {r["doc_id"]: r for r in P.report(P.find(docs, model)).collect()}
    assert len(out) == len(rows)
    for r in rows:
        base, o = brute(r["text"]), out[r["doc_id"]]
        line = ",".join(f"{k}:{i}:{j}" for i, j, k in base)
        assert o["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        spans = o["spans"].split(",") if o["spans"] else []
        assert set(filter(None, line.split(","))) <= set(spans)
        for k in P.KINDS:
            assert o[f"n_{k}"] == sum(s.startswith(k + ":") for s in spans)


def test_windows_reconcile(monkeypatch):
    """A span is found whole and once wherever it lies against the window edges."""
    def tag_signs(model, x):  # stands in for the network: runs of @ are emails
        on = x == P._ids("@")[0]
        first = on & ~np.concatenate([np.zeros((len(x), 1), bool), on[:, :-1]], axis=1)
        return np.where(first, 1, np.where(on, 2, 0)).astype(np.int8), np.ones(x.shape, np.float32)
    monkeypatch.setattr(B, "decode", tag_signs)
    for pad in range(0, 420, 3):
        texts = ["x" * pad + "@" * 40 + "y" * (420 - pad), "", "no sign", "@" * 7 + "z" * pad + "@" * 9]
        got = P.added_spans(texts, [[], [], [], []], None, 0.9)
        assert got[:3] == [[(pad, pad + 40, "email")], [], []]
        assert got[3] == ([(0, 7, "email"), (7 + pad, 16 + pad, "email")] if pad else [(0, 16, "email")])


def test_spans_beyond_hinted_windows(monkeypatch):
    """A span that goes on far beyond the windows with a digit or @ is found whole, and masked whole."""
    def tag_letters(model, x):  # stands in for the network: runs of a and @ are emails
        on = (x == P._ids("@")[0]) | (x == P._ids("a")[0])
        first = on & ~np.concatenate([np.zeros((len(x), 1), bool), on[:, :-1]], axis=1)
        return np.where(first, 1, np.where(on, 2, 0)).astype(np.int8), np.ones(x.shape, np.float32)
    monkeypatch.setattr(B, "decode", tag_letters)
    for pad in range(0, 400, 7):
        for before, after in ((130, 0), (0, 130), (300, 5), (5, 700), (400, 400)):
            span = "a" * before + "@" + "a" * after
            text = "x" * pad + span + "y" * 300 + "a" * 50 + "z" * 200
            assert P.added_spans([text], [[]], None, 0.9) == [[(pad, pad + len(span), "email")]]


def test_mask_and_odd_rows(spark, model):
    rows = [(1, None, 1), (2, "", 1), (None, "mail a@b.co now", 1), (3, "ip 10.0.0.1 and 10.0.0.1", 1),
            (3, "ip 10.0.0.1 and 10.0.0.1", 1), (4, "word " * 100000 + "x@y.org", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pii int").withColumn("n_ip", F.lit("clash"))
    got = P.report(P.find(docs, None)).collect()
    assert [(r["doc_id"], r["n_email"], r["n_ip"], r["spans"]) for r in got] == [
        (1, 0, 0, ""), (2, 0, 0, ""), (None, 1, 0, "email:5:11"), (3, 0, 2, "ip:3:11,ip:16:24"),
        (3, 0, 2, "ip:3:11,ip:16:24"), (4, 1, 0, "email:500000:500007")]
    assert [r["text"] for r in P.mask(docs, None).collect()][:5] == [None, "", "mail [EMAIL] now", "ip [IP] and [IP]", "ip [IP] and [IP]"]
    assert P.find(docs.limit(0), model).count() == 0
    assert P.train(docs.filter("doc_id < 3")) is None
    assert P._replace("abcdefgh", [(0, 4, "ip"), (2, 6, "phone"), (5, 7, "card")]) == "[IP]h"
