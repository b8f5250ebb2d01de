"""Published table set, staging and JDBC-free round trips."""

import datetime as dt
import os

from tickerpulse.session import staged as stage
from tickerpulse.sinks.tables import publish_all, read_table, write_table

FACT = ("id string, source string, author_id string, created_at timestamp_ntz, date date, month int, day int, "
        "hour int, like_count bigint, quote_count bigint, reply_count bigint, retweet_count bigint, "
        "text string, tickers array<string>, tags array<string>")

EXPECTED = {
    "top5_stock_statistics_new": "tickers:string,cnt:bigint,retweets:bigint,final_result:bigint",
    "tag_freq_new": "ticker:string,cnt:bigint",
    "test_days_list": "t_day:timestamp_ntz,cnt:bigint",
    "popular_tags_daily_count_new": "t_day:timestamp_ntz,tag:string,cnt:bigint,rank:bigint",
    "popular_tags_hourly_count_new": "t_hour:timestamp_ntz,tag:string,ref_tag:string,cnt:bigint,rank:bigint",
    "timing_ticker_freq_df": "tickers:string,cnt:bigint",
    "mdhr_tags": "month:int,day:int,hour:int,tickers:string,tags:string",
    "top_tags": "tickers:string,date:date,month:int,day:int,hour:int,tags:string,times:bigint",
}


def _fact(spark):
    t = dt.datetime(2022, 11, 1, 3, 4)
    d = t.date()
    rows = [("1", "cashtag", "a", t, d, 11, 1, 3, 1, 0, 0, 5, "x", ["AAPL", "MU"], ["NEWS"]),
            ("2", "hashtag", "b", t, d, 11, 1, 3, 0, 0, 0, 1, "y", ["MU"], []),
            ("3", "hashtag", "c", None, None, None, None, None, 0, 0, 0, 0, "z", None, ["Q"])]
    return spark.createDataFrame(rows, FACT)


def test_publish_all_schemas(spark, tmpdir_path):
    paths = publish_all(_fact(spark), tmpdir_path)
    assert len(paths) == 12
    for name, schema in EXPECTED.items():
        got = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in read_table(spark, name, tmpdir_path).schema)
        assert got == schema, name
    stats = {r["tickers"]: r["final_result"] for r in read_table(spark, "top5_stock_statistics_new", tmpdir_path).collect()}
    assert stats == {"AAPL": 6, "MU": 8, "": 1}
    assert any(d.startswith("date=") for d in os.listdir(os.path.join(tmpdir_path, "posts")))
    posts = read_table(spark, "posts", tmpdir_path).where("date = DATE'2022-11-01'")
    assert "PartitionFilters: [isnotnull(date" in posts._jdf.queryExecution().executedPlan().toString()
    assert posts.count() == 2


def test_stage_cuts_lineage(spark):
    f = stage(_fact(spark), "t")
    assert "Scan parquet" in f._jdf.queryExecution().executedPlan().toString()
    assert f.count() == 3


def test_partitioned_write(spark, tmpdir_path):
    write_table(_fact(spark).select("id", "source", "tickers"), "p", tmpdir_path, partition_by=["source"])
    assert sorted(os.listdir(os.path.join(tmpdir_path, "p")))[:2] == ["._SUCCESS.crc", "_SUCCESS"] or \
        any(d.startswith("source=") for d in os.listdir(os.path.join(tmpdir_path, "p")))
    back = read_table(spark, "p", tmpdir_path)
    assert sorted(r["tickers"] for r in back.collect()) == ["", "AAPL,MU", "MU"]


def test_daily_close_join_becomes_broadcast_at_run_time(spark):
    import __spark_entry__ as E
    df = E.queries()["hourly_with_daily_close"](spark, "/root/testdata/sf0.001")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final


def test_sizing_follows_volume():
    from tickerpulse.session import sizing_conf
    big = sizing_conf(100 * 1024 ** 4, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    small = sizing_conf(10 << 20, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_price_day_fetch_is_bounded(spark):
    import pytest
    import __spark_entry__ as E
    from tickerpulse.sinks.tables import fetch_bounded, price_day
    view = E.queries()["price_day_view"](spark, "/root/testdata/sf0.001")
    pdf = price_day(view, "VIEW", "2024-01-02", 24)
    assert list(pdf["hour"]) == sorted(pdf["hour"]) and len(pdf) <= 24
    with pytest.raises(ValueError):
        fetch_bounded(view, 3)


def test_sizing_open_cost_only_drops_for_small_inputs():
    from tickerpulse.session import sizing_conf
    assert int(sizing_conf(100 * 1024 ** 4, 8000)["spark.sql.files.openCostInBytes"]) == 4 << 20
    assert int(sizing_conf(40 << 20, 8)["spark.sql.files.openCostInBytes"]) == (40 << 20) // 32


def test_partitioned_write_is_rebalanced(spark, tmpdir_path):
    from tickerpulse.sinks.tables import rebalanced
    df = spark.range(2000).selectExpr("id", "CAST(id % 7 AS INT) AS d").repartition(16)
    plan = rebalanced(df, ["d"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    write_table(df, "r", tmpdir_path, partition_by=["d"], flatten=False)
    folders = [f for f in os.listdir(os.path.join(tmpdir_path, "r")) if f.startswith("d=")]
    files = sum(len([x for x in os.listdir(os.path.join(tmpdir_path, "r", f)) if x.endswith(".parquet")])
                for f in folders)
    assert len(folders) == 7 and files < 16 * 7  # not one file per (task, folder)


def test_lookup_sql_binds_parameters(spark, tmpdir_path):
    t = dt.datetime(2022, 11, 1)
    daily = spark.createDataFrame([(t, "MU", 3, 1), (t, "AAPL", 2, 2)],
                                  "t_day timestamp_ntz, tag string, cnt bigint, rank bigint")
    write_table(daily, "popular_tags_daily_count_new", tmpdir_path)
    read_table(spark, "popular_tags_daily_count_new", tmpdir_path).createOrReplaceTempView("pd_test")
    q = "SELECT tag, cnt FROM pd_test WHERE tag = :tag"
    assert [r["tag"] for r in spark.sql(q, args={"tag": "MU"}).collect()] == ["MU"]
    assert spark.sql(q, args={"tag": "x' OR '1'='1"}).count() == 0  # a value, never SQL text
