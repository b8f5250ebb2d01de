"""Price bars and their joins with mention counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeparts import bucket, time_parts
from .facts import explode_tickers


def ohlcv(ticks: DataFrame, unit: str) -> DataFrame:
    """OHLCV bars per (ticker, ``unit`` bucket) from ticks
    (ticker, ts, price, seq, size). Open / close are the prices of the
    first / last tick by (ts, seq), so equal timestamps cannot make the
    result depend on task order. The pair is one decimal (microseconds, then
    the sequence), which a hash aggregate can hold: no tick is sorted, and
    partial aggregation keeps a hot ticker's state at one row per task."""
    order = F.expr("CAST(unix_micros(CAST(ts AS TIMESTAMP)) AS DECIMAL(18, 0)) * CAST('100000000000000000000' AS DECIMAL(21, 0))"
                   " + CAST(seq AS DECIMAL(19, 0))")
    return ticks.groupBy("ticker", bucket("ts", unit).alias("t")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        F.sum("size").alias("volume"))


def hourly_bars(ticks: DataFrame) -> DataFrame:
    """ticker, date, month, day, hour, open, high, low, close, volume."""
    b = ohlcv(ticks, "hour")
    p = time_parts("t")
    return b.select("ticker", p["date"].alias("date"), p["month"].alias("month"),
                    p["day"].alias("day"), p["hour"].alias("hour"),
                    "open", "high", "low", "close", "volume")


def daily_bars(ticks: DataFrame) -> DataFrame:
    """ticker, date, month, day, open, high, low, close, volume."""
    b = ohlcv(ticks, "day")
    p = time_parts("t")
    return b.select("ticker", p["date"].alias("date"), p["month"].alias("month"),
                    p["day"].alias("day"), "open", "high", "low", "close", "volume")


def daily_from_hourly(hourly: DataFrame) -> DataFrame:
    """Daily bars rolled up from hourly bars: the day's open is the first
    hour's open, its close the last hour's close. Reads one row per bar
    hour instead of every tick again."""
    return hourly.groupBy("ticker", "date").agg(
        F.min_by("open", "hour").alias("open"), F.max("high").alias("high"),
        F.min("low").alias("low"), F.max_by("close", "hour").alias("close"),
        F.sum("volume").alias("volume")) \
        .select("ticker", "date", F.month("date").alias("month"), F.dayofmonth("date").alias("day"),
                "open", "high", "low", "close", "volume")


def raw_hourly_bars(bars: DataFrame) -> DataFrame:
    """Normalised hourly bars back to the collector's text shape (date, ``HH:mm``)."""
    return bars.select("ticker", F.date_format("date", "yyyy-MM-dd").alias("date"),
                       F.format_string("%02d:00", "hour").alias("time"),
                       "open", "high", "low", "close", "volume")


def hour_tag_text(top3: DataFrame) -> DataFrame:
    """Per (ticker, date, month, day, hour): ``"#TAG: n, "`` pieces of the top tags in rank order.

    The input holds at most k rows per key (already ranked), so the
    collected list is bounded by k.
    """
    piece = F.concat(F.lit("#"), F.col("tags"), F.lit(": "), F.col("times").cast("string"), F.lit(", "))
    g = top3.groupBy("tickers", "date", "month", "day", "hour").agg(
        F.array_sort(F.collect_list(F.struct("rank", piece.alias("p")))).alias("ps"))
    return g.select(F.col("tickers").alias("ticker"), "date", "month", "day", "hour",
                    F.array_join(F.transform("ps", lambda x: x["p"]), "").alias("times"))


def price_with_tags(bars: DataFrame, tag_text: DataFrame) -> DataFrame:
    """Every hourly bar with its hour's tag text (``''`` when there is none)."""
    j = bars.join(tag_text.drop("month", "day"), ["ticker", "date", "hour"], "left")
    return j.withColumn("times", F.coalesce("times", F.lit("")))


def with_daily_close(bars: DataFrame, daily: DataFrame) -> DataFrame:
    """Hourly bars with the day's close beside them, 0 when the day has no bar.

    The daily side has one row per (ticker, day); it is not hinted, AQE
    broadcasts it when its measured size is small.
    """
    d = daily.select("ticker", "date", F.col("close").alias("daily_close"))
    j = bars.join(d, ["ticker", "date"], "left")
    return j.withColumn("daily_close", F.coalesce("daily_close", F.lit(0.0)))


def hourly_mentions(fact: DataFrame) -> DataFrame:
    m = explode_tickers(fact, keep_cols=("created_at",)).where(F.col("ticker").isNotNull())
    return m.groupBy("ticker", bucket("created_at", "hour").alias("t_hour")) \
        .agg(F.count(F.lit(1)).alias("mentions"))


def popularity_vs_price(fact: DataFrame, ticks: DataFrame) -> DataFrame:
    """Every bar hour with its mentions (0 when there are none), and the change of
    price and mentions against the hour before; NULL where the hour before has no bar.

    The window runs per ticker over hourly rows, so its partition size is
    bounded by the number of hours covered, not by the number of posts.
    """
    bars = ohlcv(ticks, "hour").select("ticker", F.col("t").alias("t_hour"), "close")
    j = bars.join(hourly_mentions(fact), ["ticker", "t_hour"], "left") \
        .withColumn("mentions", F.coalesce("mentions", F.lit(0).cast("bigint")))
    w = Window.partitionBy("ticker").orderBy("t_hour")
    follows = F.lag("t_hour").over(w) == F.col("t_hour") - F.expr("INTERVAL 1 HOUR")
    return j.select(
        "ticker", "t_hour", "mentions", "close",
        F.when(follows, F.col("close") - F.lag("close").over(w)).alias("price_change"),
        F.when(follows, F.col("mentions") - F.lag("mentions").over(w)).alias("mention_change"))


def date_filter(df: DataFrame, prefix: str, col: str = "date") -> DataFrame:
    """``yyyy-MM-dd`` (one day) or ``yyyy-MM`` (one month) prefix on a date column,
    written as a range: on a table partitioned by that column it prunes folders."""
    if len(prefix) == 10:
        start = F.to_date(F.lit(prefix))
        return df.where(F.col(col) == start)
    start = F.to_date(F.lit(prefix + "-01"))
    return df.where((F.col(col) >= start) & (F.col(col) < F.add_months(start, 1)))
