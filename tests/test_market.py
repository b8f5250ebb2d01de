"""Bars and hour tag text (FIXTURES F3, F4, F6)."""

import datetime as dt

from pyspark.sql import functions as F

from tickerpulse.functions.timeparts import epoch_millis_parts
from tickerpulse.operators import market, ranking
from tickerpulse.sources.bars import normalise_hourly


def test_epoch_millis_around_midnight(spark):
    # 2022-11-01T04:30:00Z is 00:30 in New York; 03:59:59.999Z is still the day before there
    ms = [1667277000000, 1667275199999]
    df = spark.createDataFrame([(m,) for m in ms], "ms bigint")
    ny = epoch_millis_parts(F.col("ms"), "America/New_York")
    utc = epoch_millis_parts(F.col("ms"), "UTC")
    got = df.select(ny["date"], ny["time"], utc["date"], utc["time"]).collect()
    assert [tuple(r) for r in got] == [("2022-11-01", "00:30", "2022-11-01", "04:30"),
                                       ("2022-10-31", "23:59", "2022-11-01", "03:59")]


def test_hourly_normalise_keeps_pre_market_and_gaps(spark):
    raw = spark.createDataFrame([("AAPL", "2022-11-01", "04:00", 1.0, 2.0, 0.5, 1.5, 10.0),
                                 ("AAPL", "2022-11-01", "09:00", 1.5, 1.5, 1.5, 1.5, 1.0)],
                                "ticker string, date string, time string, open double, high double, "
                                "low double, close double, volume double")
    got = [(r["month"], r["day"], r["hour"]) for r in normalise_hourly(raw).orderBy("hour").collect()]
    assert got == [(11, 1, 4), (11, 1, 9)]  # no rows are invented for missing hours


def test_ohlcv_order_by_time_then_sequence(spark):
    t = dt.datetime(2024, 1, 1, 10, 0)
    ticks = spark.createDataFrame([("A", t, 5.0, 2, 1.0), ("A", t, 7.0, 1, 1.0),
                                   ("A", t + dt.timedelta(minutes=59), 6.0, 3, 2.0)],
                                  "ticker string, ts timestamp_ntz, price double, seq bigint, size double")
    r = market.hourly_bars(ticks).first()
    assert (r["open"], r["high"], r["low"], r["close"], r["volume"]) == (7.0, 7.0, 5.0, 6.0, 4.0)
    d = market.daily_from_hourly(market.hourly_bars(ticks)).first()
    assert (d["open"], d["close"], d["volume"]) == (7.0, 6.0, 4.0)


def test_bars_are_hash_aggregated(spark):
    ticks = spark.createDataFrame([("A", dt.datetime(2024, 1, 1), 5.0, -2, 1.0)],
                                  "ticker string, ts timestamp_ntz, price double, seq bigint, size double")
    plan = market.hourly_bars(ticks)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2


D1, D2 = dt.date(2022, 11, 1), dt.date(2023, 11, 1)


def test_hour_tag_text_top3_ties_short_hours_and_years(spark):
    top = spark.createDataFrame([
        ("AAPL", D1, 11, 1, 3, "B", 2), ("AAPL", D1, 11, 1, 3, "A", 2), ("AAPL", D1, 11, 1, 3, "C", 5),
        ("AAPL", D1, 11, 1, 3, "D", 1), ("AAPL", D1, 11, 1, 4, "Z", 1), ("AAPL", D2, 11, 1, 3, "Y", 9)],
        "tickers string, date date, month int, day int, hour int, tags string, times bigint")
    tt = market.hour_tag_text(ranking.top_tags_per_hour(top, 3))
    text = {(r["date"], r["hour"]): r["times"] for r in tt.collect()}
    assert text == {(D1, 3): "#C: 5, #A: 2, #B: 2, ", (D1, 4): "#Z: 1, ", (D2, 3): "#Y: 9, "}
    bars = spark.createDataFrame([("AAPL", d, 11, 1, h, 1.0) for d in (D1, D2) for h in (3, 4, 5)],
                                 "ticker string, date date, month int, day int, hour int, close double")
    got = {(r["date"], r["hour"]): r["times"] for r in market.price_with_tags(bars, tt).collect()}
    assert got[(D1, 5)] == "" and got[(D1, 3)].startswith("#C") and got[(D2, 3)] == "#Y: 9, " and got[(D2, 4)] == ""


def test_popularity_over_every_bar_hour(spark):
    t = dt.datetime(2024, 1, 1)
    ticks = spark.createDataFrame([("A", t + dt.timedelta(hours=h), float(p), h, 1.0) for h, p in ((0, 10), (1, 11), (2, 13), (3, 16), (5, 20))],
                                  "ticker string, ts timestamp_ntz, price double, seq bigint, size double")
    fact = spark.createDataFrame([(t, ["A"]), (t + dt.timedelta(hours=3), ["A"]), (t + dt.timedelta(hours=3), ["A", "B"])],
                                 "created_at timestamp_ntz, tickers array<string>")
    got = [(r["t_hour"].hour, r["mentions"], r["price_change"], r["mention_change"])
           for r in market.popularity_vs_price(fact, ticks).orderBy("t_hour").collect()]
    assert got == [(0, 1, None, None), (1, 0, 1.0, -1), (2, 0, 2.0, 0), (3, 2, 3.0, 2), (5, 0, None, None)]


def test_published_bars_prune_by_date(spark, tmpdir_path):
    from tickerpulse.sinks.tables import publish_bars, read_table
    t = dt.datetime(2024, 1, 1)
    ticks = spark.createDataFrame([("A", t + dt.timedelta(hours=7 * h), float(h), h, 1.0) for h in range(20)],
                                  "ticker string, ts timestamp_ntz, price double, seq bigint, size double")
    publish_bars(ticks, tmpdir_path)
    day = market.date_filter(read_table(spark, "stocks_hourly", tmpdir_path), "2024-01-03")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and day.count() == 4
    daily = {r["date"]: (r["open"], r["close"], r["volume"]) for r in read_table(spark, "stocks_monthly", tmpdir_path).collect()}
    assert daily == {r["date"]: (r["open"], r["close"], r["volume"]) for r in market.daily_bars(ticks).collect()}
