"""Counts, ranking, rules, pages and views on small hand-written fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from tickerpulse.constants import RULE_SIZE_CASHTAG, RULE_SIZE_HASHTAG, TICKERS
from tickerpulse.operators import counts, ranking, views
from tickerpulse.operators.quality import filter_audit
from tickerpulse.operators.rules import build_rules, rule_match
from tickerpulse.sources.webpages import page_cells, page_links

FACT_SCHEMA = ("id string, created_at timestamp_ntz, month int, day int, hour int, "
               "retweet_count bigint, text string, tickers array<string>, tags array<string>")


def _fact(spark, rows):
    return spark.createDataFrame(rows, FACT_SCHEMA)


def T(d, h):
    return dt.datetime(2022, 11, d, h, 5)


def test_counts_keep_null_group_and_ties(spark):
    f = _fact(spark, [
        ("1", T(1, 0), 11, 1, 0, 3, "a", ["AAPL", "MU"], ["X", "Y"]),
        ("2", T(1, 0), 11, 1, 0, 1, "b", ["MU"], ["X"]),
        ("3", T(1, 23), 11, 1, 23, 0, "c", [], []),
        ("4", None, None, None, None, 0, "d", None, ["Z"]),
        ("5", T(2, 5), 11, 2, 5, 2, "e", ["AAPL"], ["STOCKS"]),
    ])
    st = {r["tickers"]: r for r in counts.ticker_statistics(f).collect()}
    assert st["MU"]["cnt"] == 2 and st["MU"]["retweets"] == 4 and st["MU"]["final_result"] == 6
    assert st[""]["cnt"] == 2  # NULL ticker group (empty and NULL arrays)
    top = counts.ticker_freq_top(f, 2).collect()
    assert [(r["ticker"], r["cnt"]) for r in top] == [("AAPL", 2), ("MU", 2)]
    hourly = {(r["tag"], r["ref_tag"]): r["cnt"] for r in counts.ticker_tag_hourly(f).collect()}
    assert hourly == {("AAPL", "X"): 1, ("AAPL", "Y"): 1, ("MU", "X"): 2, ("MU", "Y"): 1}
    # NULL and [] are separate groups; both are written as ''
    sets = sorted((r["tickers"], r["cnt"]) for r in counts.ticker_set_freq(f).collect())
    assert sets == [("", 1), ("", 1), ("AAPL", 1), ("AAPL,MU", 1), ("MU", 1)]
    lv = counts.tag_counts(f, "hour").where(F.col("tickers").isNull()).collect()
    assert sorted(r["cnt_t"] for r in lv) == [0, 1]  # count(tags) ignores NULL tags


def test_top_k_ties_are_deterministic(spark):
    d = spark.createDataFrame([(T(1, 0), t, 5) for t in ["E", "D", "C", "B", "A", "F"]],
                              "t_day timestamp_ntz, tag string, cnt bigint")
    got = ranking.top_daily(d, 3).orderBy("rank").collect()
    assert [(r["tag"], r["rank"]) for r in got] == [("A", 1), ("B", 2), ("C", 3)]


def test_top_then_exclude_leaves_fewer(spark):
    h = spark.createDataFrame([(T(1, 0), "EBAY", "X", 9), (T(1, 0), "MU", "Y", 1)],
                              "t_hour timestamp_ntz, tag string, ref_tag string, cnt bigint")
    assert [r["tag"] for r in ranking.top_then_exclude(h, ["EBAY"], 5).collect()] == ["MU"]


def test_top_tags_drops_empty_and_self(spark):
    d = dt.date(2022, 11, 1)
    fact = spark.createDataFrame([(d, 11, 1, 0, ["AAPL", "MU"], ["AAPL", "NEWS", ""]), (d, 11, 1, 0, [], [""]),
                                  (d, 11, 1, 0, None, ["NEWS"]), (d.replace(year=2023), 11, 1, 0, ["MU"], ["NEWS", "NEWS"])],
                                 "date date, month int, day int, hour int, tickers array<string>, tags array<string>")
    got = {(r["date"].year, r["tickers"], r["tags"]): r["times"] for r in counts.top_tags(fact).collect()}
    assert got == {(2022, "AAPL", "NEWS"): 1, (2022, "MU", "AAPL"): 1, (2022, "MU", "NEWS"): 1, (2022, "", "NEWS"): 1, (2023, "MU", "NEWS"): 2}
    flat = spark.createDataFrame([(11, 1, 0, "AAPL,MU", "AAPL,NEWS,"), (11, 1, 0, "", "")],
                                 "month int, day int, hour int, tickers string, tags string")
    compat = {(r["tickers"], r["tags"]) for r in counts.drop_self_tags(flat, False).collect()}
    assert ("AAPL,MU", "AAPL") in compat


def test_rules_from_listing(spark):
    listing = spark.createDataFrame([(0, i, s) for i, s in enumerate(TICKERS)],
                                    "page_id int, rank int, symbol string")
    six = build_rules(listing, RULE_SIZE_CASHTAG, "$").orderBy("rule_no").collect()
    assert len(six) == 17
    assert six[0]["value"] == "$AAPL OR $MSFT OR $AMZN OR $TSLA OR $GOOG OR $GOOGL"
    assert len(build_rules(listing, RULE_SIZE_HASHTAG, "#").collect()) == 6
    posts = spark.createDataFrame([("p1", "about $GOOGL and #aapl"), ("p2", "nothing")],
                                  "id string, text string")
    m = rule_match(posts, build_rules(listing, 6)).collect()
    assert [(r["id"], r["rule_no"]) for r in m] == [("p1", 0)]


HTML = ('<a href="/symbol/AAPL">Apple</a><a href="/symbol/AAPL">AAPL</a>'
        '<a href="/symbol/MSFT">Microsoft</a><a href="/symbol/MSFT">MSFT</a>'
        '<td class="text-nowrap">1.0</td><td class="text-nowrap">+0.1</td><td class="text-nowrap">1%</td>'
        '<td class="text-nowrap">2.0</td><td class="text-nowrap">-0.2</td><td class="text-nowrap">-2%</td>'
        '<td class="text-nowrap">S&P 500</td><td class="text-nowrap">9</td>')


def test_listing_page(spark):
    pages = spark.createDataFrame([(1, "u", HTML)], "page_id bigint, url string, html string")
    assert [r["link"] for r in page_links(pages, "/symbol/").collect()] == ["AAPL", "MSFT"]
    cells = page_cells(pages, '<td class="text-nowrap">([^<]*)</td>', "S&P 500").orderBy("rec").collect()
    assert [(r["price"], r["chg"], r["pct_chg"]) for r in cells] == [("1.0", "+0.1", "1%"), ("2.0", "-0.2", "-2%")]


def test_leader_cube_fills_missing_hours(spark):
    H = lambda d, h: dt.datetime(2022, 11, d, h)
    leaders = spark.createDataFrame([(H(1, 0), "A•X", 3), (H(1, 5), "B•Y", 2), (H(2, 1), "A•Z", 1)],
                                    "t_hour timestamp_ntz, stock string, cnt bigint")
    cube = views.leader_cube(leaders).collect()
    assert len(cube) == 24  # day 2 is the partial last day and is dropped
    cells = {r["hour"]: (r["stock"], r["cnt"]) for r in cube}
    assert cells[0] == ("A•X", 3) and cells[5] == ("B•Y", 2) and cells[3] == (None, 0)


def test_daily_frames_dense(spark):
    D = lambda d: dt.datetime(2022, 11, d)
    top = spark.createDataFrame([(D(1), 1, "A", 5), (D(3), 1, "B", 2), (D(4), 1, "C", 1)],
                                "t_day timestamp_ntz, rank bigint, tag string, cnt bigint")
    fr = views.daily_frames(top, k=2).collect()
    assert len(fr) == 6  # days 1..3 (4 is last) x 2 slots
    assert {(r["t_day"].day, r["rank"]): r["cnt"] for r in fr}[(2, 1)] == 0


def test_filter_audit_three_valued(spark):
    f = spark.createDataFrame([
        ("Check out", ["EBAY"], []), ("Check out x", None, []), ("ok", None, ["EPEX"]),
        ("#MU", ["MU"], ["EPEX"]), ("fine", ["AAPL"], [])],
        "text string, tickers array<string>, tags array<string>")
    r = filter_audit(f).first()
    assert (r["rows_in"], r["after_rule_1"], r["after_rule_2"], r["after_rule_3"]) == (5, 5, 3, 1)


def test_daily_close_defaults_to_zero(spark):
    from tickerpulse.operators.market import with_daily_close
    bars = spark.createDataFrame([("A", dt.date(2024, 1, 1), 10, 1.5), ("A", dt.date(2024, 1, 2), 10, 2.5)],
                                 "ticker string, date date, hour int, close double")
    daily = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.25)], "ticker string, date date, close double")
    got = sorted((r["date"].day, r["daily_close"]) for r in with_daily_close(bars, daily).collect())
    assert got == [(1, 1.25), (2, 0.0)]


def test_resum_sort_option(spark):
    c = spark.createDataFrame([(11, 1, 0, "A", "X", 1), (11, 1, 0, "B", "Y", 3)],
                              "month int, day int, hour int, tickers string, tags string, cnt_t bigint")
    assert [r["tickers"] for r in counts.tag_counts_resum(c, "hour", sort_desc=True).collect()] == ["B", "A"]


def test_rules_scoped_to_one_source(spark):
    from tickerpulse.operators.quality import apply_rules
    f = spark.createDataFrame([("hashtag", "Check out", ["EBAY"], []), ("cashtag", "Check out", ["EBAY"], []),
                               (None, "Check out", ["EBAY"], [])],
                              "source string, text string, tickers array<string>, tags array<string>")
    kept = sorted(str(r["source"]) for r in apply_rules(f, only_source="hashtag").collect())
    assert kept == ["None", "cashtag"]


def test_grids_with_a_single_day(spark):
    H = lambda h: dt.datetime(2022, 11, 1, h)
    leaders = spark.createDataFrame([(H(0), "A•X", 3), (H(5), "B•Y", 2)],
                                    "t_hour timestamp_ntz, stock string, cnt bigint")
    assert views.leader_cube(leaders).count() == 0          # the only day is the partial last day
    assert views.leader_cube(leaders, drop_last_day=False).count() == 24
    top = spark.createDataFrame([(dt.datetime(2022, 11, 1), 1, "A", 5)],
                                "t_day timestamp_ntz, rank bigint, tag string, cnt bigint")
    assert views.daily_frames(top, k=2).count() == 0
    assert views.daily_frames(top, k=2, drop_last_day=False).count() == 2


def test_rules_from_listing_page_html(spark):
    html = "".join(f'<a href="/symbol/{s}">Name {i}</a><a href="/symbol/{s}">{s}</a>'
                   for i, s in enumerate(TICKERS))
    pages = spark.createDataFrame([(7, "u", html)], "page_id bigint, url string, html string")
    links = page_links(pages, "/symbol/")
    listing = links.select("page_id", ((F.col("pos") - 1) / 2).cast("bigint").alias("rank"),
                           F.upper("link").alias("symbol"))
    rules = build_rules(listing, RULE_SIZE_CASHTAG, "$").orderBy("rule_no").collect()
    assert len(rules) == 17 and [len(r["symbols"]) for r in rules] == [6] * 17
    assert rules[-1]["value"] == " OR ".join("$" + t for t in TICKERS[96:])
    assert [s for r in rules for s in r["symbols"]] == list(TICKERS)


def test_global_listing_one_rule_per_symbol(spark):
    from tickerpulse.operators.rules import global_listing
    listing = spark.createDataFrame([(2, 0, "MU"), (1, 1, "AAPL"), (1, 0, "EBAY"), (2, 1, "AAPL")],
                                    "page_id int, rank int, symbol string")
    g = global_listing(listing).orderBy("rank").collect()
    assert [(r["rank"], r["symbol"]) for r in g] == [(0, "EBAY"), (1, "AAPL"), (2, "MU")]
    rules = build_rules(global_listing(listing), 2).orderBy("rule_no").collect()
    assert [r["symbols"] for r in rules] == [["EBAY", "AAPL"], ["MU"]]
    posts = spark.createDataFrame([("p", "$aapl #MU $MU")], "id string, text string")
    assert sorted(r["rule_no"] for r in rule_match(posts, build_rules(global_listing(listing), 2)).collect()) == [0, 1]
