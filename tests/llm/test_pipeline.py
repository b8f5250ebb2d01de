"""Every stage of the pipeline against a plain version of its decision."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as C
from tickerpulse.llm import op7_toxicity
from tickerpulse.llm.common import stored

from .test_op2_simhash import brute_components, brute_fp
from .test_op5_mixing import brute_targets
from .test_op8_packing import check_packing
from .test_op9_pii import brute

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def check_stages(spark, docs, sf):
    seen = {}
    for name, stage in C.STAGES:
        out = stored(stage(spark, docs, sf), "t")
        before, after = docs.collect(), out.collect()
        seen[name] = len(after)
        if name == "toxicity":
            model = op7_toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
            bad = {f for f in model.weights}
            kept = Counter(map(tuple, after))
            assert not kept - Counter(map(tuple, before))
            for r in before:
                if not any(f in bad for w in op7_toxicity.words(r["text"]) for f in op7_toxicity.features(w)):
                    assert kept[tuple(r)]
        elif name == "simhash_near_dedup":
            fps = [brute_fp(r["text"]) for r in before]
            comp = brute_components(fps, 2)
            classes = {frozenset(comp[i]) for i in range(len(before))}
            want = Counter(min(((before[i]["doc_id"] is None, before[i]["doc_id"] or 0) for i in c)) for c in classes)
            assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in after) == want
            assert not Counter(map(tuple, after)) - Counter(map(tuple, before))
        elif name == "pii":
            assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before)
            old = {r["doc_id"]: r["text"] for r in before}
            for r in after:
                if r["text"] is None:
                    assert old[r["doc_id"]] is None
                    continue
                assert r["n_chars"] == len(r["text"]) and not brute(r["text"])
                if not brute(old[r["doc_id"]]) and "[" not in r["text"]:
                    assert r["text"] == old[r["doc_id"]]
        elif name == "mixing":
            assert not set(map(tuple, after)) - set(map(tuple, before))
            assert all(n <= 2 * Counter(map(tuple, before))[k] for k, n in Counter(map(tuple, after)).items())
            _, target = brute_targets([(r["source"], words(r["text"])) for r in before])
            taken, biggest = defaultdict(int), defaultdict(int)
            for r in after:
                taken[r["source"]] += words(r["text"])
            for r in before:
                biggest[r["source"]] = max(biggest[r["source"]], words(r["text"]))
            for s, t in target.items():
                assert abs(taken[s] - t) <= max(biggest[s], 0.05 * t)
        else:
            n, least = check_packing([(r["doc_id"], r["text"]) for r in before], after)
            assert n <= 1.02 * least + 1
        if name != C.STAGES[-1][0]:
            assert out.columns == COLUMNS
        docs = out
    return seen


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    seen = check_stages(spark, docs, SF)
    assert 0 < seen["simhash_near_dedup"] < seen["toxicity"] < docs.count()


def test_odd_rows(spark, tmpdir_path):
    rows = [(1, None, "en", "a", 0), (2, "", None, None, 0), (None, "mail a@b.co now and then", "en", "a", 9), (3, "same row again here", "en", "b", 3),
            (3, "same row again here", "en", "b", 3), (4, "same row again here", "de", "b", None), (None, "other words are told", None, None, None),
            (5, "word and more " * 3000, "en", "c", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmpdir_path}/labels.parquet")
    assert check_stages(spark, spark.createDataFrame(rows, schema), tmpdir_path)["simhash_near_dedup"] == 5
    spark.createDataFrame([], schema).write.parquet(f"{tmpdir_path}/documents.parquet")
    assert C.run(spark, tmpdir_path).count() == 0


def test_registered(spark):
    assert "pipeline" in E.queries() and C.run.__name__ == E.queries()["pipeline"].__name__
    assert len(C.STAGES) == 5
    found = E.queries()["pipeline"](spark, SF)
    assert found.filter(F.col("length") > 2048).count() == 0 and found.count() > 0
