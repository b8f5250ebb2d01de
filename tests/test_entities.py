"""Identification and tag extraction: fixtures, edge cases, differential test."""

import datetime as dt
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tickerpulse.constants import TICKERS
from tickerpulse.functions.entities import (extract_cashtags, extract_hashtags,
                                            identify_tickers, non_symbol_tags)
from tickerpulse.operators.facts import post_fact, tweets_to_posts
from tickerpulse.operators.identify import identify_and_tag, identify_posts
from tickerpulse.operators.quality import apply_rules
from tickerpulse.sources.envelopes import (corrupt_files, flatten_envelope, read_envelopes,
                                            repair_unclosed)

UNIVERSE = ["AAPL", "GOOG", "GOOGL", "EBAY", "MU"]
CTX = [{"id": "c1", "text": "context"}]

# (text, includes.tweets, strict tickers, tags, kept in strict mode, default tickers, kept default)
CASES = [
    ("Check out my #EBAY", CTX, ["EBAY"], ["EBAY"], False, ["EBAY"], False),
    ("#ebay #boutique", CTX, ["EBAY"], ["EBAY", "BOUTIQUE"], False, ["EBAY"], False),
    ("#MU #EPEX", CTX, ["MU"], ["MU", "EPEX"], False, ["MU"], False),
    ("hello", [{"id": "c2", "text": "$AAPL and #goog"}], ["AAPL", "GOOG"], [], True, ["AAPL", "GOOG"], True),
    ("#EBAY good", CTX, ["EBAY"], ["EBAY"], True, ["EBAY"], True),
    ("#EBAY no includes", None, None, ["EBAY"], True, ["EBAY"], True),
    ("plain", CTX, [], [], True, [], True),
    ("Check out no includes", None, None, [], False, [], True),
]


def _tweet(i, text, ctx):
    t = {"data": {"id": str(i), "text": text, "author_id": "a", "conversation_id": "c",
                  "created_at": f"2022-11-0{1 + i % 2}T0{i % 10}:04:05.000Z",
                  "public_metrics": {"like_count": i, "quote_count": 0, "reply_count": 0,
                                     "retweet_count": 2 * i}},
         "includes": {}}
    if ctx is not None:
        t["includes"]["tweets"] = ctx
    return t


def _write_envelope(folder, name, cases):
    # exactly the collector's layout: {"tweets":[t1,t2,...,{}]}
    body = "{\"tweets\":[" + "".join(json.dumps(_tweet(i, c[0], c[1])) + "," for i, c in enumerate(cases)) \
        + "{}]}"
    with open(os.path.join(folder, name), "w") as f:
        f.write(body)


def _posts(spark, folder, strict, keep_sentinel=False):
    env = read_envelopes(spark, os.path.join(folder, "*.json"))
    tweets = flatten_envelope(env, keep_sentinel=keep_sentinel)
    posts = tweets_to_posts(tweets, "cashtag")
    return post_fact(identify_and_tag(posts, UNIVERSE, context_col="tweets", strict_compat=strict))


def test_envelope_fixture_strict(spark, tmpdir_path):
    _write_envelope(tmpdir_path, "2022_11_1_0_0.json", CASES)
    fact = _posts(spark, tmpdir_path, strict=True)
    rows = {r["text"]: r for r in fact.collect()}
    assert len(rows) == len(CASES)
    for text, _, strict_t, tags, _, _, _ in CASES:
        assert rows[text]["tickers"] == strict_t, text
        assert rows[text]["tags"] == tags, text
    kept = {r["text"] for r in apply_rules(fact).collect()}
    assert kept == {c[0] for c in CASES if c[4]}


def test_envelope_fixture_default(spark, tmpdir_path):
    _write_envelope(tmpdir_path, "2022_11_1_0_0.json", CASES)
    fact = _posts(spark, tmpdir_path, strict=False)
    rows = {r["text"]: r for r in fact.collect()}
    for text, _, _, _, _, default_t, _ in CASES:
        assert rows[text]["tickers"] == default_t, text
    kept = {r["text"] for r in apply_rules(fact).collect()}
    assert kept == {c[0] for c in CASES if c[6]}


def test_sentinel_row_semantics(spark, tmpdir_path):
    _write_envelope(tmpdir_path, "a.json", CASES[:2])
    fact = _posts(spark, tmpdir_path, strict=True, keep_sentinel=True)
    sentinel = [r for r in fact.collect() if r["id"] is None]
    assert len(sentinel) == 1
    assert sentinel[0]["tickers"] is None and sentinel[0]["tags"] == []
    # the sentinel never survives the text rule (NULL OR NULL)
    assert all(r["id"] is not None for r in apply_rules(fact).collect())


def test_created_at_parts(spark, tmpdir_path):
    _write_envelope(tmpdir_path, "a.json", CASES[:3])
    r = {x["text"]: x for x in _posts(spark, tmpdir_path, strict=False).collect()}
    row = r["#ebay #boutique"]
    assert (row["month"], row["day"], row["hour"]) == (11, 2, 1)
    assert str(row["created_at"]) == "2022-11-02 01:04:05"


def test_unclosed_file_is_counted(spark, tmpdir_path):
    _write_envelope(tmpdir_path, "good.json", CASES[:2])
    with open(os.path.join(tmpdir_path, "killed.json"), "w") as f:
        f.write("{\"tweets\":[" + json.dumps(_tweet(9, "#MU", CTX)) + ",")
    with open(os.path.join(tmpdir_path, "cut.json"), "w") as f:
        f.write("{\"tweets\":[" + json.dumps(_tweet(8, "#EBAY", CTX))[:40])
    env = read_envelopes(spark, os.path.join(tmpdir_path, "*.json"))
    assert corrupt_files(env).count() == 2
    assert flatten_envelope(env).count() == 2
    fixed = repair_unclosed(env)
    assert sorted(r["text"] for r in flatten_envelope(fixed).collect()) == ["#MU", "#ebay #boutique", "Check out my #EBAY"]
    assert corrupt_files(fixed).count() == 1  # cut inside a record: still unreadable


MATCHER = [
    ("#GOOGL", ["GOOGL"]), ("#goog|x", []), ("#AAPL1", ["AAPL"]), ("#AAPL_x", ["AAPL"]),
    ("＃mu", ["MU"]), ("#AAPLX", []), ("AAPL", []), ("#AAPL #aapl", ["AAPL"]),
    ("$MU and #EBAY", ["EBAY", "MU"]), ("##AAPL", ["AAPL"]), ("x#AAPL#MU", ["AAPL", "MU"]),
    (None, []),
]


def test_matcher_edge_cases(spark):
    df = spark.createDataFrame([(t,) for t, _ in MATCHER], "text string")
    got = [r[0] for r in df.select(identify_tickers("text", None, UNIVERSE)).collect()]
    assert got == [e for _, e in MATCHER]


TAGS = [("#éa_1 x", ["ÉA_1"]), ("#B-", ["B"]), (None, []), ("#a #a #b", ["A", "A", "B"]),
        ("#straße", ["STRASSE"])]


def test_tag_edge_cases(spark):
    df = spark.createDataFrame([(t,) for t, _ in TAGS], "text string")
    got = [r[0] for r in df.select(extract_hashtags("text")).collect()]
    assert got == [e for _, e in TAGS]


def test_cashtags(spark):
    df = spark.createDataFrame([("buy $aapl and $Mu_2 not #x",)], "text string")
    assert df.select(extract_cashtags("text")).first()[0] == ["AAPL", "MU_2"]


def test_non_symbol_tags(spark):
    df = spark.createDataFrame([("#AAPL #AAPLX #AAPL1 #goog| #news #éa",)], "text string")
    assert df.select(non_symbol_tags("text", UNIVERSE)).first()[0] == ["AAPLX", "GOOG", "NEWS", "ÉA"]


def _python_identify(text, universe):
    """Independent matcher: prefix, a universe symbol, then neither an ASCII letter nor '|'."""
    alt = "|".join(sorted(universe, key=len, reverse=True))
    pat = re.compile(r"[$#＃](" + alt + r")(?![A-Za-z|])", re.IGNORECASE)
    return sorted({m.group(1).upper() for m in pat.finditer(text)})


def _python_tags(text):
    return [t.upper() for t in re.findall(r"#(\w+)", text)] if text else []


def test_differential_against_python_re(spark):
    rnd = random.Random(7)
    pieces = ["$", "#", "＃", "|", " ", "_", "1", "é", "ß", "x", "AAPL", "aapl", "GOOG", "L",
              "goog", "MU", "mu", "EBAY", "Z", "-", "ä", "٣"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 14))) for _ in range(600)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = df.select("i", identify_tickers("text", None, TICKERS).alias("t"),
                    extract_hashtags("text").alias("g")).orderBy("i").collect()
    for r in got:
        t = texts[r["i"]]
        assert r["t"] == _python_identify(t, TICKERS), t
        assert r["g"] == _python_tags(t), t


def test_join_form_equals_literal_form(spark):
    rows = [(str(i), t, None) for i, (t, _) in enumerate(MATCHER)]
    df = spark.createDataFrame(rows, "id string, text string, tweets array<struct<id:string,text:string>>")
    u = spark.createDataFrame([(s,) for s in UNIVERSE], "symbol string")
    lit = identify_posts(df, UNIVERSE, context_col="tweets").select("id", "tickers")
    join = identify_posts(df, u, context_col="tweets").select("id", "tickers")
    assert sorted(lit.collect()) == sorted(join.collect())


def test_both_forms_agree_on_repeated_and_null_ids(spark):
    rows = [("1", "$AAPL"), ("1", "$MSFT"), (None, "$AAPL"), (None, None), ("2", "#brk.b, #été2 $x1y $MU|"), ("3", "")]
    df = spark.createDataFrame(rows, "id string, text string")
    symbols = ["AAPL", "MSFT", "BRK.B", "Été", "X1", "X1Y", "MU"]
    u = spark.createDataFrame([(s,) for s in symbols] + [(None,)], "symbol string")
    want = [("1", "$AAPL", ["AAPL"]), ("1", "$MSFT", ["MSFT"]), (None, "$AAPL", ["AAPL"]), (None, None, []),
            ("2", "#brk.b, #été2 $x1y $MU|", ["BRK.B", "X1Y", "ÉTÉ"]), ("3", "", [])]
    for universe in (symbols, u):
        got = sorted((tuple(r) for r in identify_posts(df, universe).collect()), key=str)
        assert got == sorted(want, key=str)


def test_large_universe(spark):
    """More symbols than any literal bound: every operator that takes a universe table."""
    from tickerpulse.operators import counts
    from tickerpulse.operators.context import conversation_context
    from tickerpulse.operators.identify import non_symbol_tag_posts
    u = spark.range(20001).select(F.concat(F.lit("S"), F.translate(F.col("id").cast("string"), "0123456789", "ABCDEFGHIJ")).alias("s"))
    posts = spark.createDataFrame([("1", "c", "#SCAAAA and #SCAAAB #word"), ("2", "c", "no tags"), ("3", "d", "#sb| #SC")],
                                  "id string, conversation_id string, text string")
    assert {r["id"]: r["tickers"] for r in identify_posts(posts, u).collect()} == {"1": ["SCAAAA"], "2": [], "3": ["SC"]}
    assert {r["id"]: r["tags"] for r in non_symbol_tag_posts(posts, u).collect()} == {"1": ["SCAAAB", "WORD"], "2": [], "3": ["SB"]}
    assert {r["id"]: r["tickers"] for r in conversation_context(posts, u).collect()} == {"1": ["SCAAAA"], "2": ["SCAAAA"], "3": ["SC"]}
    fact = identify_and_tag(posts, u)
    assert {(r["tag"], r["cnt"]) for r in counts.tag_freq_universe(fact, u).collect()} == {("SCAAAA", 1), ("SB", 1), ("SC", 1)}


@pytest.mark.parametrize("strict", [True, False])
def test_null_context_and_text(spark, strict):
    df = spark.createDataFrame([(None, None), ("#MU", None)],
                               "text string, tweets array<struct<id:string,text:string>>")
    got = [r[0] for r in df.select(identify_tickers("text", "tweets", UNIVERSE, strict_compat=strict)).collect()]
    assert got == ([None, None] if strict else [[], ["MU"]])


def _python_non_symbol_tags(text, universe):
    alt = "|".join(sorted(universe, key=len, reverse=True))
    pat = re.compile(r"#(?!(?:" + alt + r")(?![A-Za-z|]))(\w+)", re.IGNORECASE)
    return [m.group(1).upper() for m in pat.finditer(text)] if text else []


def test_non_symbol_tags_differential(spark):
    rnd = random.Random(11)
    pieces = ["#", "|", " ", "_", "7", "é", "x", "AAPL", "aapl", "GOOG", "L", "MU", "news", "Q", "ü"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12))) for _ in range(500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = df.select("i", non_symbol_tags("text", TICKERS).alias("g")).collect()
    for r in got:
        t = texts[r["i"]]
        assert r["g"] == _python_non_symbol_tags(t, TICKERS), t


def test_publish_job_end_to_end(spark, tmpdir_path):
    from tickerpulse import publish_job
    from tickerpulse.sinks.tables import read_table
    h, c, out = (os.path.join(tmpdir_path, d) for d in ("h", "c", "out"))
    os.makedirs(h)
    os.makedirs(c)
    _write_envelope(h, "2022_11_1_0_0.json", CASES)           # spam rules apply here
    _write_envelope(c, "2022_11_1_0_0.json", CASES[:1])       # and not here
    paths = publish_job.run(spark, os.path.join(h, "*.json"), os.path.join(c, "*.json"), out,
                            universe=UNIVERSE)
    assert len(paths) == 13
    posts = read_table(spark, "posts", out).collect()
    texts = sorted(r["text"] for r in posts)
    # hashtag side keeps the default-mode survivors, cashtag side keeps its spam post
    assert texts == sorted([t for t, *_, kept in CASES if kept] + ["Check out my #EBAY"])
    stats = {r["tickers"]: r["cnt"] for r in read_table(spark, "top5_stock_statistics_new", out).collect()}
    assert stats["EBAY"] == 3 and stats["AAPL"] == 1


def test_sql_functions_match_dataframe_functions(spark):
    from tickerpulse.functions.sql_functions import register_sql_functions
    register_sql_functions(spark, UNIVERSE)
    texts = [t for t, _ in MATCHER] + [c[0] for c in CASES] + ["#éa_1 $mu_2 #straße"]
    df = spark.createDataFrame([(str(i), t, CTX if i % 2 else None) for i, t in enumerate(texts)],
                               "id string, text string, tweets array<struct<id:string,text:string>>")
    df.createOrReplaceTempView("tp_posts")
    got = spark.sql("""SELECT id, tp_identify(text) AS a, tp_identify_ctx(text, tweets) AS b,
                              tp_hashtags(text) AS c, tp_cashtags(text) AS d,
                              tp_spam_keep(tp_identify(text), tp_hashtags(text), text) AS e
                       FROM tp_posts""").orderBy("id").collect()
    exp = df.select("id", identify_tickers("text", None, UNIVERSE).alias("a"),
                    identify_tickers("text", "tweets", UNIVERSE).alias("b"),
                    extract_hashtags("text").alias("c"), extract_cashtags("text").alias("d")).orderBy("id").collect()
    assert [tuple(r)[:5] for r in got] == [tuple(r) for r in exp]
    kept = {r["id"] for r in got if r["e"]}
    assert str(texts.index("Check out my #EBAY")) not in kept and str(texts.index("#EBAY good")) in kept
    plan = spark.sql("SELECT tp_identify(text) FROM tp_posts")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_universe_lookup_is_hashed_inside_the_lambda(spark):
    df = spark.createDataFrame([("#AAPL x",)], "text string") \
        .select(identify_tickers("text", None, TICKERS).alias("t"))
    assert "INSET" in df._jdf.queryExecution().optimizedPlan().toString().upper()
    assert df.first()["t"] == ["AAPL"]


def test_created_at_independent_of_session_zone(spark):
    from tickerpulse.functions.timeparts import parse_created_at
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([("2022-11-01T23:30:05.120Z",), ("bad",)], "c string")
            got = [r[0] for r in df.select(parse_created_at("c")).collect()]
            assert got == [dt.datetime(2022, 11, 1, 23, 30, 5, 120000), None], zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_publish_job_cli(spark, tmpdir_path, capsys):
    from tickerpulse import publish_job
    c, out = os.path.join(tmpdir_path, "c"), os.path.join(tmpdir_path, "out")
    os.makedirs(c)
    _write_envelope(c, "2022_11_1_0_0.json", CASES)
    publish_job.main(["--cashtag", os.path.join(c, "*.json"), "--out", out])
    printed = capsys.readouterr().out
    assert "top5_stock_statistics_new" in printed and "posts" in printed
    assert os.path.isdir(os.path.join(out, "popular_tags_hourly_count_new"))


def test_context_as_plain_strings(spark):
    df = spark.createDataFrame([("hi", ["$AAPL", None, "#goog|"]), ("#MU", [])],
                               "text string, ctx array<string>")
    got = [r[0] for r in df.select(identify_tickers("text", "ctx", UNIVERSE, context_is_struct=False)).collect()]
    assert got == [["AAPL"], ["MU"]]


def test_join_form_with_repeated_universe_rows(spark):
    df = spark.createDataFrame([("1", "#AAPL #aapl $MU x", None)],
                               "id string, text string, tweets array<struct<id:string,text:string>>")
    u = spark.createDataFrame([("AAPL",)] * 50 + [("MU",)] * 3, "symbol string")
    out = identify_posts(df, u, context_col="tweets")
    assert out.count() == 1 and out.first()["tickers"] == ["AAPL", "MU"]


def test_publish_job_on_line_delimited_envelopes(spark, tmpdir_path):
    from tickerpulse import publish_job
    from tickerpulse.sinks.tables import read_table
    c, out = os.path.join(tmpdir_path, "lines"), os.path.join(tmpdir_path, "out")
    os.makedirs(c)
    with open(os.path.join(c, "part-0.json"), "w") as f:
        for i, case in enumerate(CASES):
            f.write(json.dumps({"tweets": [_tweet(i, case[0], case[1]), {}]}) + "\n")
    publish_job.main(["--cashtag", c, "--out", out, "--lines"])
    assert read_table(spark, "posts", out).count() == len(CASES)  # cashtag side: no spam rules


def test_a_run_of_a_million_characters(spark):
    """Long runs without blanks take room in proportion to their length, with a list and with a table of symbols."""
    from tickerpulse.operators.identify import identify_posts, non_symbol_tag_posts
    run = "#" + "1" * 500_000 + "本" * 500_000
    posts = spark.createDataFrame([("1", run), ("2", "$7A.B #ＡＢ " + run), ("3", "$ß1")], "id string, text string")
    universe = ["7A.B", "ＡＢ", "SS1"]
    table = spark.createDataFrame([(s,) for s in universe], "symbol string")
    for u in (universe, table):
        got = {r["id"]: sorted(r["tickers"]) for r in identify_posts(posts, u).select("id", "tickers").collect()}
        assert got == {"1": [], "2": sorted(universe[:2]), "3": ["SS1"]}
    assert {r["id"]: len(r["tags"]) for r in non_symbol_tag_posts(posts, table).collect()} == {"1": 1, "2": 1, "3": 0}


def test_rule_semi_judges_each_post_by_its_own_text(spark):
    from tickerpulse.operators.rules import rule_semi
    rules = spark.createDataFrame([(1, 0, ["AAPL", "MU"])], "page_id int, rule_no long, symbols array<string>")
    posts = spark.createDataFrame([("1", "$AAPL"), ("1", "nothing"), (None, "$AAPL"), (None, None), ("2", "#mu $AAPL")], "id string, text string")
    assert sorted(map(str, rule_semi(posts, rules).collect())) == sorted(map(str, posts.filter("text LIKE '%AAPL%'").collect()))


def test_a_post_without_conversation_keeps_its_own_symbols(spark):
    from tickerpulse.operators.context import conversation_context
    posts = spark.createDataFrame([("1", "$AAPL", None), ("2", "$MU", None), ("3", "$MU", "c"), ("4", "x", "c")], "id string, text string, conversation_id string")
    table = spark.createDataFrame([("AAPL",), ("MU",)], "symbol string")
    for u in (["AAPL", "MU"], table):
        got = {r["id"]: r["tickers"] for r in conversation_context(posts, u).collect()}
        assert got == {"1": ["AAPL"], "2": ["MU"], "3": ["MU"], "4": ["MU"]}
