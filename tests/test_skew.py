"""Hot keys: one conversation / symbol holding a third of all rows."""

import contextlib

from pyspark.sql import functions as F

from tickerpulse.operators.context import conversation_context
from tickerpulse.operators.counts import ticker_statistics


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _turns(spark, n=3000):
    # conversation "hot" holds a third of all turns; the rest are small
    rows = []
    for i in range(n):
        conv = "hot" if i % 3 == 0 else f"c{i % 500}"
        text = "#AAPL" if i == 0 else ("#MU x" if i % 7 == 1 else "plain words")
        rows.append((f"p{i}", conv, text))
    return spark.createDataFrame(rows, "id string, conversation_id string, text string").repartition(8)


def test_hot_conversation_is_split_and_exact(spark):
    turns = _turns(spark)
    with conf(spark, **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}):
        out = conversation_context(turns, ["AAPL", "MU"])
        got = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan  # the hot conversation's partition is split
    by_conv = {}
    for r in got:
        by_conv.setdefault(r["conversation_id"], set()).add(tuple(r["tickers"]))
    assert by_conv["hot"] == {("AAPL", "MU")}
    assert len(got) == 3000


def test_no_hot_keys_plain_join(spark):
    turns = _turns(spark, 300)
    out = conversation_context(turns, ["AAPL", "MU"])
    assert out.count() == 300


def test_hot_symbol_counts_combine_map_side(spark):
    rows = [(["HOT"] if i % 3 == 0 else [f"S{i % 50}"], i % 5) for i in range(3000)]
    fact = spark.createDataFrame(rows, "tickers array<string>, retweet_count bigint").repartition(8)
    st = ticker_statistics(fact)
    plan = st._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_sum" in plan
    hot = st.where(F.col("tickers") == "HOT").first()
    assert hot["cnt"] == 1000 and hot["retweets"] == sum(i % 5 for i in range(0, 3000, 3))


def test_null_keys_skip_the_join(spark):
    rows = [(f"p{i}", None if i % 3 == 0 else f"c{i % 40}", "#MU" if i % 2 else "x") for i in range(900)]
    turns = spark.createDataFrame(rows, "id string, conversation_id string, text string")
    out = conversation_context(turns, ["MU"])
    got = {r["id"]: r["tickers"] for r in out.collect()}
    assert len(got) == 900
    assert got["p0"] == [] and got["p1"] == ["MU"] and got["p2"] == [] and got["p5"] == ["MU"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan


def test_factorized_pair_counts_equal_naive_pairs(spark):
    import datetime as dt
    import random
    from tickerpulse.functions.timeparts import bucket
    from tickerpulse.operators.counts import pair_counts_hourly, tag_counts
    from tickerpulse.operators.facts import explode_pairs
    rnd = random.Random(3)
    sets = [["HOT"], ["HOT"], ["HOT"], ["A", "B"], [], None, ["B"]]
    tags = [["X", "X", "Y"], [], None, ["Z"], ["X"]]
    rows = []
    for i in range(600):
        t = dt.datetime(2024, 1, 1 + i % 3, i % 5)
        rows.append((t, t.month, t.day, t.hour, rnd.choice(sets), rnd.choice(tags)))
    fact = spark.createDataFrame(rows, "created_at timestamp_ntz, month int, day int, hour int, "
                                       "tickers array<string>, tags array<string>")
    naive = explode_pairs(fact).groupBy(bucket("created_at", "hour").alias("t_hour"),
                                        F.col("ticker").alias("tag"), F.col("tag").alias("ref_tag")) \
        .agg(F.count(F.lit(1)).alias("cnt"))
    assert sorted(map(tuple, pair_counts_hourly(fact).collect()), key=repr) == \
        sorted(map(tuple, naive.collect()), key=repr)
    naive_lv = explode_pairs(fact, keep_cols=("month", "day")).groupBy(
        "month", "day", F.col("ticker").alias("tickers"), F.col("tag").alias("tags")) \
        .agg(F.count("tag").alias("cnt_t"))
    assert sorted(map(tuple, tag_counts(fact, "day").collect()), key=repr) == \
        sorted(map(tuple, naive_lv.collect()), key=repr)
