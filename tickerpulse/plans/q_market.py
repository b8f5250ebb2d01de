"""Registered price-bar queries and their joins with mention counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timeparts import epoch_millis_parts
from ..operators import counts, market, ranking
from ..operators.asof import asof_join
from ..session import scratch_path
from ..sinks.tables import publish_bars, read_table
from ..sources import driver_tables as dt
from ..sources.bars import normalise_hourly
from . import sql as S
from .inputs import event_fact, table
from .registry import query

_TICKS = """
ticks AS (SELECT upper(event_type) AS ticker, ts, value AS price, event_id AS seq, CAST(1.0 AS DOUBLE) AS size FROM events)"""

_HOURLY = _TICKS + """,
hb AS (
  SELECT ticker, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS t,
         arg_min(price, row(ts, seq)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, row(ts, seq)) AS close, sum(size) AS volume
  FROM ticks GROUP BY 1, 2),
hourly AS (
  SELECT ticker, CAST(t AS DATE) AS date, CAST(month(t) AS INTEGER) AS month, CAST(day(t) AS INTEGER) AS day,
         CAST(hour(t) AS INTEGER) AS hour, open, high, low, close, volume FROM hb)"""

_DAILY = """
db AS (
  SELECT ticker, CAST(date_trunc('day', ts) AS TIMESTAMP) AS t,
         arg_min(price, row(ts, seq)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, row(ts, seq)) AS close, sum(size) AS volume
  FROM ticks GROUP BY 1, 2),
daily AS (
  SELECT ticker, CAST(t AS DATE) AS date, CAST(month(t) AS INTEGER) AS month, CAST(day(t) AS INTEGER) AS day,
         open, high, low, close, volume FROM db)"""

_TAGTEXT = """
flat AS (SELECT date, month, day, hour, coalesce(array_to_string(tickers, ','), '') AS tickers,
                coalesce(array_to_string(tags, ','), '') AS tags FROM ev_fact),
ex1 AS (SELECT date, month, day, hour, unnest(string_split(tickers, ',')) AS tickers, tags FROM flat),
ex2 AS (SELECT date, month, day, hour, tickers, unnest(string_split(tags, ',')) AS tags FROM ex1),
top_tags AS (SELECT tickers, date, month, day, hour, tags, count(tags) AS times FROM ex2
             WHERE tags <> '' AND tags <> tickers GROUP BY tickers, date, month, day, hour, tags),
top3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tickers, date, hour
                                                      ORDER BY times DESC, tags ASC) AS rank FROM top_tags)
         WHERE rank <= 3),
tag_text AS (SELECT tickers AS ticker, date, month, day, hour,
                    string_agg('#' || tags || ': ' || CAST(times AS VARCHAR) || ', ', '' ORDER BY rank) AS times
             FROM top3 GROUP BY 1, 2, 3, 4, 5)"""


def _ticks(spark, sf_dir):
    return dt.event_ticks(table(spark, sf_dir, "events"))


def _published_bars(spark, sf_dir) -> str:
    """Both bar tables published in a folder of their own; returns its path."""
    base = scratch_path(spark, "bars")
    publish_bars(_ticks(spark, sf_dir), base)
    return base


def _tag_text(spark, sf_dir):
    top = counts.top_tags(event_fact(spark, sf_dir))
    return market.hour_tag_text(ranking.top_tags_per_hour(top, k=3))


@query("ohlcv_hourly", S.with_(_HOURLY) + "SELECT * FROM hourly")
def ohlcv_hourly(spark, sf_dir):
    """Hourly OHLCV bars from the event price ticks."""
    return market.hourly_bars(_ticks(spark, sf_dir))


@query("ohlcv_daily", S.with_(_TICKS, _DAILY) + "SELECT * FROM daily")
def ohlcv_daily(spark, sf_dir):
    return market.daily_bars(_ticks(spark, sf_dir))


@query("hour_tag_text", S.with_(S.EV_POSTS, _TAGTEXT) + "SELECT * FROM tag_text")
def hour_tag_text(spark, sf_dir):
    """Top-3 tag text per (ticker, date, hour)."""
    return _tag_text(spark, sf_dir)


@query("price_with_tags", S.with_(S.EV_POSTS, _TAGTEXT, _HOURLY) + """
SELECT h.ticker, h.month, h.day, h.hour, h.date, h.open, h.high, h.low, h.close, h.volume,
       coalesce(t.times, '') AS times
FROM hourly h LEFT JOIN tag_text t ON t.ticker = h.ticker AND t.date = h.date AND t.hour = h.hour""")
def price_with_tags(spark, sf_dir):
    return market.price_with_tags(market.hourly_bars(_ticks(spark, sf_dir)), _tag_text(spark, sf_dir))


@query("hourly_with_daily_close", S.with_(_HOURLY, _DAILY) + """
SELECT h.ticker, h.date, h.month, h.day, h.hour, h.close, coalesce(d.close, 0.0) AS daily_close
FROM hourly h LEFT JOIN daily d USING (ticker, date)""")
def hourly_with_daily_close(spark, sf_dir):
    """Hourly close beside the day's close (0 where a day has no daily bar)."""
    hourly = market.hourly_bars(_ticks(spark, sf_dir))
    daily = market.daily_from_hourly(hourly)
    return market.with_daily_close(hourly, daily) \
        .select("ticker", "date", "month", "day", "hour", "close", "daily_close")


@query("price_day_view", S.with_(S.EV_POSTS, _TAGTEXT, _HOURLY, _DAILY) + """
SELECT h.ticker, h.date, h.month, h.day, h.hour, h.open, h.high, h.low, h.close, h.volume,
       coalesce(t.times, '') AS times, coalesce(d.close, 0.0) AS daily_close
FROM hourly h LEFT JOIN tag_text t ON t.ticker = h.ticker AND t.date = h.date AND t.hour = h.hour
LEFT JOIN daily d ON d.ticker = h.ticker AND d.date = h.date""")
def price_day_view(spark, sf_dir):
    """Published bars + hour tag text + daily close for every (ticker, date) at once."""
    base = _published_bars(spark, sf_dir)
    view = market.price_with_tags(read_table(spark, "stocks_hourly", base), _tag_text(spark, sf_dir))
    return market.with_daily_close(view, read_table(spark, "stocks_monthly", base)).select(
        "ticker", "date", "month", "day", "hour", "open", "high", "low", "close", "volume",
        "times", "daily_close")


@query("popularity_vs_price", S.with_(S.EV_POSTS, _TICKS) + """
, m AS (SELECT unnest(tickers) AS ticker, CAST(date_trunc('hour', created_at) AS TIMESTAMP) AS t_hour FROM ev_fact),
mh AS (SELECT ticker, t_hour, count(*) AS mentions FROM m WHERE ticker IS NOT NULL GROUP BY 1, 2),
hb AS (SELECT ticker, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS t_hour, arg_max(price, row(ts, seq)) AS close
       FROM ticks GROUP BY 1, 2),
j AS (SELECT ticker, t_hour, coalesce(mentions, 0) AS mentions, close FROM hb LEFT JOIN mh USING (ticker, t_hour)),
w AS (SELECT *, lag(t_hour) OVER p AS pt, lag(close) OVER p AS pc, lag(mentions) OVER p AS pm FROM j
      WINDOW p AS (PARTITION BY ticker ORDER BY t_hour))
SELECT ticker, t_hour, mentions, close,
       CASE WHEN pt = t_hour - INTERVAL 1 HOUR THEN close - pc END AS price_change,
       CASE WHEN pt = t_hour - INTERVAL 1 HOUR THEN mentions - pm END AS mention_change
FROM w""")
def popularity_vs_price(spark, sf_dir):
    return market.popularity_vs_price(event_fact(spark, sf_dir), _ticks(spark, sf_dir))


@query("bars_point_lookup", S.with_(_HOURLY) + """
SELECT * FROM hourly WHERE ticker = 'VIEW' AND month = 1 AND day = 15""")
def bars_point_lookup(spark, sf_dir):
    """Hourly bars of one (ticker, month, day) from the published table; the day picks its folders."""
    b = read_table(spark, "stocks_hourly", _published_bars(spark, sf_dir))
    return _in_order(b.where((F.col("ticker") == "VIEW") & (F.month("date") == 1) & (F.dayofmonth("date") == 15)))


def _in_order(bars):
    return bars.select("ticker", "date", "month", "day", "hour", "open", "high", "low", "close", "volume")


@query("date_prefix_filter", S.with_(_HOURLY) + """
SELECT * FROM hourly WHERE CAST(date AS VARCHAR) LIKE '2024-01-17%'""")
def date_prefix_filter(spark, sf_dir):
    """Published hourly bars of one date prefix: only its folders are read."""
    return _in_order(market.date_filter(read_table(spark, "stocks_hourly", _published_bars(spark, sf_dir)), "2024-01-17"))


@query("bars_universe", S.with_(S.EV_POSTS, _TICKS, _DAILY) + """
SELECT * FROM daily WHERE ticker IN (SELECT DISTINCT unnest(tickers) FROM ev_fact)""")
def bars_universe(spark, sf_dir):
    """Daily bars of symbols that are mentioned at least once (semi join)."""
    mentioned = event_fact(spark, sf_dir).select(F.explode("tickers").alias("ticker")).distinct()
    return market.daily_bars(_ticks(spark, sf_dir)).join(mentioned, "ticker", "left_semi")


@query("bars_normalise", S.with_(_HOURLY) + """
SELECT ticker, date, month, day, hour, open, high, low, close, volume FROM hourly""")
def bars_normalise(spark, sf_dir):
    """Collector-shaped bars (date text, ``HH:mm`` text) back to typed, year-less keys."""
    raw = market.raw_hourly_bars(market.hourly_bars(_ticks(spark, sf_dir)))
    return normalise_hourly(raw)


@query("epoch_to_parts", """
SELECT event_id, strftime(make_timestamp(epoch_ms(ts) * 1000), '%Y-%m-%d') AS date,
       strftime(make_timestamp(epoch_ms(ts) * 1000), '%H:%M') AS time
FROM events""")
def epoch_to_parts(spark, sf_dir):
    """Epoch milliseconds to the collector's date and ``HH:mm`` text (UTC pinned)."""
    ev = table(spark, sf_dir, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    p = epoch_millis_parts(ms, "UTC")
    return ev.select("event_id", p["date"].alias("date"), p["time"].alias("time"))


@query("mentions_asof_price", S.with_(_HOURLY) + """
, m AS (SELECT upper(event_type) AS ticker, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS t_hour, count(*) AS cnt FROM events GROUP BY 1, 2),
session AS (SELECT ticker, t, close FROM hb WHERE isodow(t) <= 5 AND hour(t) BETWEEN 9 AND 15)
SELECT m.ticker, m.t_hour, m.cnt, s.t AS asof, s.close FROM m ASOF LEFT JOIN session s ON m.ticker = s.ticker AND m.t_hour >= s.t""")
def mentions_asof_price(spark, sf_dir):
    """Hourly mentions beside the last bar of a trading session (weekdays, 9 to 15) that is not later: nights and weekends keep the last price."""
    ev = table(spark, sf_dir, "events")
    mentions = ev.groupBy(F.upper("event_type").alias("ticker"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("t_hour")) \
        .agg(F.count(F.lit(1)).alias("cnt"))
    bars = market.ohlcv(dt.event_ticks(ev), "hour").filter("weekday(t) < 5 AND hour(t) BETWEEN 9 AND 15").select("ticker", "t", "close")
    return asof_join(mentions, bars, "ticker", "t_hour", "t", ["close"])
