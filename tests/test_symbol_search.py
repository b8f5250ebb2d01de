"""The table form of identification: same rows as the plain definition, and what its plans may not do."""

import random

import pytest
from pyspark.sql import functions as F

from tickerpulse.functions import entities as E
from tickerpulse.functions.sql_functions import register_sql_functions
from tickerpulse.operators import identify
from tickerpulse.operators.identify import identify_and_tag, non_symbol_tag_posts
from tickerpulse.operators.rules import rule_semi
from tickerpulse.plans import q_streaming, q_text
from tickerpulse.streaming import jobs

SYMBOLS = ["AB", "ABC", "B.A", "éA", "ßA", "1", "Z"]


@pytest.fixture(scope="module")
def posts(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("aBzé1.|_$#＃ \t\x0bß😀-") for _ in range(rnd.randint(0, 40))) for _ in range(800)]
    texts += ["#ab #ABC| $b.a", "#ab #ABC| $b.a", "＃éa #ßa", "#" + "1." * 3000, "", None, None]
    return spark.createDataFrame([(str(i % 700) if i % 9 else None, t) for i, t in enumerate(texts)], "id string, text string")


def _rows(df):
    return sorted(map(repr, df.collect()))


def _universe(spark):
    return spark.createDataFrame([(s,) for s in SYMBOLS + ["AB", None]], "symbol string")


def _named(c):
    """Every beginning of every run, quadratic in it."""
    runs = F.regexp_extract_all(c, F.lit("[\\$#＃]([^\\s\\$#＃]+)"), F.lit(1))
    cands = F.flatten(F.transform(runs, lambda r: F.transform(E.beginnings(F.substring(r, 1, 9)), F.upper)))
    return F.array_sort(F.array_distinct(F.filter(F.coalesce(cands, F.array().cast("array<string>")), lambda x: x.isin([s.upper() for s in SYMBOLS]))))


def test_table_form_equals_the_definition(spark, posts):
    got = identify_and_tag(posts, _universe(spark))
    assert got.columns == ["id", "text", "tickers", "tags"]
    assert _rows(got) == _rows(posts.select("id", "text", _named(F.col("text")).alias("tickers"), E.extract_hashtags("text").alias("tags")))


def test_context_and_strict_nulls(spark, posts):
    ctx = posts.withColumn("tweets", F.when(F.length("text") % 3 > 0, F.array(
        F.struct(F.lit("c").alias("id"), F.reverse("text").alias("text")), F.struct(F.lit("d").alias("id"), F.lit(None).cast("string").alias("text")))))
    for strict in (False, True):
        got = identify_and_tag(ctx, _universe(spark), context_col="tweets", strict_compat=strict).select("id", "tickers")
        both = F.array_sort(F.array_union(_named(F.col("text")), F.when(F.col("tweets").isNull(), F.array().cast("array<string>")).otherwise(_named(F.reverse("text")))))
        want = F.when(F.col("text").isNull() | F.col("tweets").isNull(), F.lit(None)).otherwise(both) if strict else both
        assert _rows(got) == _rows(ctx.select("id", want.alias("tickers")))


def test_other_tags_rules_and_stream_hits(spark, posts):
    got = non_symbol_tag_posts(posts, _universe(spark))
    assert _rows(got) == _rows(posts.withColumn("tags", F.coalesce(E.non_symbol_tags("text", [s.upper() for s in SYMBOLS]), F.array().cast("array<string>"))))
    rules = spark.createDataFrame([(1, 0, [s.upper() for s in SYMBOLS])], "page_id long, rule_no long, symbols array<string>")
    assert _rows(rule_semi(posts, rules)) == _rows(posts.where(F.size(_named(F.col("text"))) > 0))
    hits = jobs.rule_hits(posts, rules.select(F.explode("symbols").alias("symbol")))
    assert _rows(hits.select("id", "symbol")) == _rows(posts.select("id", F.explode(_named(F.col("text"))).alias("symbol")))


def test_sql_candidates_of_given_lengths(spark, posts):
    lengths = E.symbol_lengths(_universe(spark))
    register_sql_functions(spark, prefix="tss_", lengths=lengths)
    got = posts.selectExpr("id", "text", "tss_candidates(text) AS c")
    want = posts.select("id", "text", F.coalesce(F.array_sort(E.symbol_candidates("text", lengths)), F.array().cast("array<string>")).alias("c"))
    assert _rows(got) == _rows(want)
    # a long run gave one candidate a beginning, thousands of them
    assert got.agg(F.max(F.size("c"))).first()[0] <= 40


def test_sql_identify_keys_are_not_candidate_sets(spark, tmpdir_path):
    d = spark.createDataFrame([(i, " ".join(f"w{chr(97 + j % 26)}{'x' * (5 + j // 26)}" for j in range(200)) + " symbol", "en", "s", 9) for i in range(5)],
                              "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([(1, '<a href="/a">n</a><a href="/b">symbol</a>')], "page_id long, html string").write.parquet(f"{tmpdir_path}/pages.parquet")
    out = q_text.sql_identify(spark, tmpdir_path)
    assert [r.tickers for r in out.collect()] in (["SYMBOL"] * 5, [["SYMBOL"]] * 5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "cands" not in plan  # the set of candidates was a join and grouping key, repeated for each of its members


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_candidates_equal_the_beginnings_of_every_run(spark, posts):
    for lengths in ([1], [2, 3, 5], list(range(1, 10)), []):
        runs = F.regexp_extract_all("text", F.lit(E.SYMBOL_RUN), F.lit(1))
        each = F.array_distinct(F.transform(F.flatten(F.transform(runs, lambda r: E.beginnings(r, lengths))), F.upper))
        got = posts.select("text", F.array_sort(E.symbol_candidates("text", lengths)).alias("c"))
        assert _rows(got) == _rows(posts.select("text", F.array_sort(each).alias("c")))


def test_many_symbols_are_joined_with_the_same_rows(spark, posts, monkeypatch):
    ctx = posts.withColumn("tweets", F.when(F.length("text") % 3 > 0, F.array(F.struct(F.lit("c").alias("id"), F.reverse("text").alias("text")))))

    def rows(universe):
        return [_rows(identify_and_tag(posts, universe)), _rows(non_symbol_tag_posts(posts, universe)),
                *(_rows(identify_and_tag(ctx, universe, context_col="tweets", strict_compat=s)) for s in (False, True))]

    nothing = spark.createDataFrame([(None,)], "symbol string")
    for universe in (_universe(spark), nothing):
        few = rows(universe)
        for name in ("SET_SYMBOLS", "SET_CHARS"):
            with monkeypatch.context() as m:
                m.setattr(identify, name, -1)
                assert "Join" in _plan(identify_and_tag(posts, universe))
                assert rows(universe) == few


def test_union_of_identified_posts_moves_no_post(spark, posts):
    """Found symbols went back to the posts by a join, which shuffled posts and tags once it was too large to broadcast."""
    plan = _plan(identify_and_tag(posts, _universe(spark)))
    assert "Join" not in plan and "Exchange" not in plan


def test_non_symbol_tags_move_no_post(spark, posts):
    plan = _plan(non_symbol_tag_posts(posts, _universe(spark)))
    assert "Join" not in plan and "Exchange" not in plan


def test_stream_identify_reads_the_pages_once(spark, tmpdir_path, monkeypatch):
    spark.createDataFrame([(1, "see symbol there", "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([(1, '<a href="/a">n</a><a href="/b">symbol</a>')], "page_id long, html string").write.parquet(f"{tmpdir_path}/pages.parquet")
    read = []
    monkeypatch.setattr(q_streaming, "identify_and_tag", lambda b, u: read.extend(u.inputFiles()) or identify_and_tag(b, u))
    assert [(r.id, r.tickers) for r in q_streaming.stream_identify(spark, tmpdir_path).collect()] == [("1", ["SYMBOL"])]
    assert read and not any("pages.parquet" in f for f in read)  # every micro-batch searched the pages again
