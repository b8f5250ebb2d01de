"""Rows that differ in NULLs alone, clashing names, and a row repeated very often, in the stages that tell rows apart."""

from collections import Counter

from tickerpulse.llm import op2_simhash, op5_mixing
from tickerpulse.llm.common import row_key, stored

SCHEMA = "doc_id long, text string, lang string, source string"


def test_rows_that_differ_in_nulls_alone(spark):
    rows = [(1, "some text here", None, "x"), (1, "some text here", "x", None), (1, None, "some text here", "x"), (None, "some text here", "x", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert df.select(row_key(df.columns).alias("k")).distinct().count() == 4
    mixed = stored(op5_mixing.mix(df), "t")
    want = {(r["id"], r["source"], r["size"], r["same"]): r["copies"] for r in mixed.collect()}
    got = Counter(map(tuple, op5_mixing.apply_copies(df, mixed).collect()))
    assert max(got.values()) <= 2 and sum(got.values()) == sum(want.values())
    assert len(op2_simhash.keep_one(df).collect()) == 2  # one class of words, one without


def test_clashing_names(spark):
    names = ["_key", "_same", "_copies", "_copy", "copies", "same", "row_key", "size", "a.b"]
    rows = [(i, "text number %d of these" % i, "en", "s", *range(len(names))) for i in range(3)] * 2
    df = spark.createDataFrame(rows, SCHEMA + "".join(f", `{n}` int" for n in names))
    kept = op2_simhash.keep_one(df)
    assert kept.columns == df.columns and sorted(map(tuple, kept.collect())) == sorted(set(rows))
    mixed = stored(op5_mixing.mix(df), "t")
    out = op5_mixing.apply_copies(df, mixed)
    assert out.columns == df.columns
    assert Counter(map(tuple, out.collect())) == Counter({rows[r["id"]]: r["copies"] for r in mixed.collect() if r["copies"]})


def test_a_row_repeated_very_often(spark):
    df = spark.createDataFrame([(1, "old text", "en", "a"), (2, "another one", "en", "b")], SCHEMA)
    many = df.filter("doc_id = 1").crossJoin(spark.range(100_000)).drop("id").repartition(4).unionByName(df.filter("doc_id = 2"))
    mixed = stored(op5_mixing.mix(many), "t")
    copies = {r["id"]: r["copies"] for r in mixed.collect()}
    got = {r["doc_id"]: r["count"] for r in op5_mixing.apply_copies(many, mixed).groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in copies.items() if v} and copies[1] > 100_000
