"""Separator scan against a plain split of the files; round trip of documents; odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickerpulse.llm import op6_token_counts as T
from tickerpulse.llm import tokens

SF = "/root/testdata/sf0.01"


def plain(ids, end):
    out, at = [], 0
    for i, x in enumerate(ids):
        if x == end:
            out.append((len(out), at, i - at))
            at = i + 1
    if at < len(ids):
        out.append((len(out), at, len(ids) - at))
    return out


@pytest.mark.parametrize("block", [1, 2, 7, 64, 100000])
def test_scan_against_plain_split(spark, tmpdir_path, block):
    rng = np.random.default_rng(block)
    files = []
    for k, ids in enumerate([rng.integers(0, 5, 300), np.zeros(50, int), np.full(40, 9), rng.integers(1, 9, 200), np.array([0]), np.array([3]),
                             np.concatenate([np.full(130, 4), [0, 0], np.full(200, 5)]), np.array([], int)]):
        path = f"{tmpdir_path}/f{k}.bin"
        ids.astype("<u4").tofile(path)
        files.append((path, len(ids), ids.tolist()))
    listed = spark.createDataFrame([f[:2] for f in files] + [files[0][:2]], "file string, tokens long")
    got = sorted(map(tuple, T.scan(listed, end=0, dtype="<u4", block_tokens=block).select("file", "ordinal", "start", "tokens").collect()))
    assert got == sorted((p, *d) for p, _, ids in files for d in plain(ids, 0))


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain_ = Tokenizer.from_file(tokens.VOCABULARY)
    want = {r["doc_id"]: len(plain_.encode(r["text"], add_special_tokens=False).ids) for r in docs.collect()}
    got = T.count_documents(spark, docs.repartition(3), block_tokens=5000).collect()
    assert len(got) == len(want) and {r["doc_id"]: r["tokens"] for r in got} == want


def test_ordinary_ids():
    plain_, ordinary = Tokenizer.from_file(tokens.VOCABULARY), tokens._ordinary(tokens.VOCABULARY)
    for t in ("", "a b", "日本 語", "  x\n\n1,000 é", "don't  stop", "ﬁ № 𝔘"):
        assert plain_.encode(t, add_special_tokens=False).ids == ordinary.encode(t, add_special_tokens=False).ids == tokens.encode_ordinary(t).tolist()
    for t in ("a<|endoftext|>b", "<|endoftext|>", "日本 x<|endoftext|>y", " <|endoftext|> "):
        ids = tokens.encode_ordinary(t).tolist()
        assert T.END not in ids and plain_.decode(ids, skip_special_tokens=False) == t


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "same"), (3, "same"), (4, "日本 x<|endoftext|>y"), (5, "word " * 50000),
            (6, "a<|endoftext|>b"), (7, "<|endoftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("file", F.lit(1)).withColumn("ordinal", F.lit("x"))
    got = T.count_documents(spark, docs, block_tokens=1000)
    fast = tokens._fast(tokens.RANKS)  # knows no special token
    want = sorted((-1 if i is None else i, len(fast.encode_ordinary(t or ""))) for i, t in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["tokens"]) for r in got.collect()) == want
    assert (6, 9) in want and (7, 7) in want
    assert T.count_documents(spark, docs.limit(0)).count() == 0
    with pytest.raises(Exception, match="within a text"):
        T.write_flat(docs, T.scratch_path(spark, "clash"), end=int(tokens.encode("same")[0])).collect()
    with pytest.raises(Exception, match="shorter than listed"):
        T.scan(T.write_flat(docs, T.scratch_path(spark, "short")).select("file", (F.col("tokens") + 5).alias("tokens"))).collect()
