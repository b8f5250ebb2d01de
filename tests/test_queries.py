"""Every registered query against its DuckDB oracle on the smallest tables,
and plan properties of the core queries."""

import duckdb
import pytest

import __spark_entry__ as E
from tickerpulse.plans import catalog
from tools.oracle_check import TABLES, key, rows_of_duck, rows_of_spark

SF_SMALL = "/root/testdata/sf0.001"

NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sc, sr = rows_of_spark(E.queries()[name](spark, SF_SMALL))
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sr) > 0
        return
    dc, dr = rows_of_duck(duck, sql)
    assert sc == dc
    assert sorted(sr, key=key) == sorted(dr, key=key)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["t_day", "tag", "cnt", "rank"]
    assert df.count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


BATCH_ONLY = [n for n in NAMES if not n.startswith("stream_") and n not in
              ("publish_all", "read_envelopes", "posts_published", "published_roundtrip",
               "sql_over_published", "write_bars_json", "write_rolled")]


@pytest.mark.parametrize("name", BATCH_ONLY)
def test_no_python_in_plans(spark, name):
    p = _plan(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


@pytest.mark.parametrize("name", ["top5_daily", "top5_hourly_tags", "top3_tags_per_hour"])
def test_top_k_uses_group_limit(spark, name):
    assert "WindowGroupLimit" in _optimized(E.queries()[name](spark, SF_SMALL))


def test_filter_on_group_keys_pushed_below_aggregate(spark):
    opt = _optimized(E.queries()["ticker_tag_hourly"](spark, SF_SMALL))
    agg_at = opt.index("Aggregate [t_hour")
    assert "STOCKS" in opt[agg_at:], "stop-tag filter should sit below the aggregate"


def test_universe_list_is_a_hashed_set_and_a_table_a_semi_join(spark):
    from tickerpulse.constants import TICKERS
    from tickerpulse.operators.identify import identify_posts
    posts = spark.createDataFrame([("$AAPL",)], "text string")
    assert "INSET" in _optimized(identify_posts(posts, TICKERS)).upper()
    assert "Join LeftSemi" in _optimized(E.queries()["tag_freq_universe"](spark, SF_SMALL))


def test_semi_join_broadcast_after_size_check(spark):
    assert "BroadcastHashJoin" in _plan(E.queries()["universe_semi"](spark, SF_SMALL)) or \
        "BroadcastExchange" in _plan(E.queries()["universe_semi"](spark, SF_SMALL))


def test_scan_reads_only_needed_columns(spark):
    p = _plan(E.queries()["ohlcv_daily"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in p \
        or "props" not in p.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.parametrize("name", ["rule_match", "hourly_with_daily_close", "price_day_view"])
def test_small_sides_broadcast_at_run_time(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final


JOIN_QUERIES = ["identify_tickers", "identify_tickers_join", "conversation_context", "rule_match",
                "rule_semi", "universe_semi", "universe_anti", "price_day_view",
                "hourly_with_daily_close", "popularity_vs_price", "leader_cube", "daily_frames",
                "bars_universe", "flatten_envelope"]


@pytest.mark.parametrize("name", JOIN_QUERIES)
def test_shuffle_join_path_matches_oracle(spark, duck, name):
    """The large-data path: with automatic and runtime broadcasts off, every
    join becomes a shuffle join and the results stay the same."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        sc, sr = rows_of_spark(df)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    dc, dr = rows_of_duck(duck, E.oracle_sql()[name])
    assert sc == dc
    assert sorted(sr, key=key) == sorted(dr, key=key)
