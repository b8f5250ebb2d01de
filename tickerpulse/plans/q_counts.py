"""Registered count and top-k queries over the event post fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timeparts import bucket
from ..operators import counts, ranking
from ..operators.numbering import numbered
from . import sql as S
from .inputs import event_fact
from .registry import query

EV = S.with_(S.EV_POSTS)

# Mentions per (day, ticker), NULL-ticker rows kept by explode_outer.
_DAILY_SQL = f"""
ev_m AS (SELECT created_at, {S.unnest_outer('tickers')} AS ticker FROM ev_fact),
daily AS (
  SELECT CAST(date_trunc('day', created_at) AS TIMESTAMP) AS t_day, ticker AS tag, count(*) AS cnt
  FROM ev_m WHERE created_at IS NOT NULL GROUP BY 1, 2
)"""

_PAIRS_SQL = f"""
ev_m AS (SELECT created_at, tags, {S.unnest_outer('tickers')} AS ticker FROM ev_fact),
ev_p AS (SELECT created_at, ticker, {S.unnest_outer('tags')} AS tag FROM ev_m),
hourly AS (
  SELECT * FROM (
    SELECT CAST(date_trunc('hour', created_at) AS TIMESTAMP) AS t_hour, ticker AS tag, tag AS ref_tag, count(*) AS cnt
    FROM ev_p GROUP BY 1, 2, 3)
  WHERE t_hour IS NOT NULL AND tag IS NOT NULL AND ref_tag IS NOT NULL AND ref_tag <> 'STOCKS'
)"""


def _with(*extra: str) -> str:
    return S.with_(S.EV_POSTS, *extra)


@query("top5_daily", _with(_DAILY_SQL) + """
SELECT t_day, tag, cnt, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY t_day ORDER BY cnt DESC, tag ASC NULLS LAST) AS rank FROM daily)
WHERE rank <= 3""")
def top5_daily(spark, sf_dir):
    """Flagship: top-3 event symbols per day (the driver data has five symbols,
    so k=3 makes the cut real)."""
    return ranking.top_daily(counts.ticker_daily_count(event_fact(spark, sf_dir)), k=3)


@query("ticker_daily_count", _with(_DAILY_SQL) + "SELECT t_day, tag, cnt FROM daily")
def ticker_daily_count(spark, sf_dir):
    return counts.ticker_daily_count(event_fact(spark, sf_dir))


@query("daily_total", _with(_DAILY_SQL) + "SELECT t_day, CAST(sum(cnt) AS BIGINT) AS cnt FROM daily GROUP BY t_day")
def daily_total(spark, sf_dir):
    return counts.daily_total(event_fact(spark, sf_dir))


@query("ticker_statistics", _with(f"""
ev_m AS (SELECT retweet_count, {S.unnest_outer('tickers')} AS ticker FROM ev_fact),
st AS (SELECT ticker, count(*) AS cnt, sum(retweet_count) AS retweets FROM ev_m GROUP BY ticker)""") + """
SELECT coalesce(ticker, '') AS tickers, cnt, CAST(retweets AS BIGINT) AS retweets, CAST(cnt + retweets AS BIGINT) AS final_result FROM st""")
def ticker_statistics(spark, sf_dir):
    return counts.ticker_statistics(event_fact(spark, sf_dir))


@query("ticker_freq_top5", _with(f"""
ev_m AS (SELECT {S.unnest_outer('tickers')} AS ticker FROM ev_fact)""") + """
SELECT upper(ticker) AS ticker, count(*) AS cnt FROM ev_m GROUP BY 1 ORDER BY cnt DESC, ticker ASC NULLS LAST LIMIT 5""")
def ticker_freq_top5(spark, sf_dir):
    return counts.ticker_freq_top(event_fact(spark, sf_dir), k=5)


@query("ticker_set_freq", _with() + """
SELECT coalesce(array_to_string(tickers, ','), '') AS tickers, count(*) AS cnt FROM ev_fact GROUP BY ev_fact.tickers""")
def ticker_set_freq(spark, sf_dir):
    return counts.ticker_set_freq(event_fact(spark, sf_dir))


@query("ticker_tag_hourly", _with(_PAIRS_SQL) + "SELECT t_hour, tag, ref_tag, cnt FROM hourly")
def ticker_tag_hourly(spark, sf_dir):
    return counts.ticker_tag_hourly(event_fact(spark, sf_dir))


_TOP_HOURLY = """
SELECT t_hour, tag, ref_tag, cnt, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY t_hour ORDER BY cnt DESC, tag ASC NULLS LAST, ref_tag ASC NULLS LAST) AS rank FROM hourly)
WHERE rank <= 5"""


@query("top5_hourly_tags", _with(_PAIRS_SQL) + _TOP_HOURLY)
def top5_hourly_tags(spark, sf_dir):
    return ranking.top_hourly_tags(counts.ticker_tag_hourly(event_fact(spark, sf_dir)), k=5)


@query("hour_leader_label", _with(_PAIRS_SQL, "ranked AS (" + _TOP_HOURLY + ")") + """
SELECT t_hour, tag || '•' || ref_tag AS stock, cnt FROM ranked WHERE rank = 1""")
def hour_leader_label(spark, sf_dir):
    return ranking.hour_leader_label(
        ranking.top_hourly_tags(counts.ticker_tag_hourly(event_fact(spark, sf_dir)), k=5))


@query("top5_then_exclude", _with(_PAIRS_SQL, "ranked AS (" + _TOP_HOURLY + ")") + """
SELECT t_hour, tag, ref_tag, cnt, rank FROM ranked WHERE tag NOT IN ('CLICK')""")
def top5_then_exclude(spark, sf_dir):
    """Rank the hourly pairs, then drop one symbol (hours may keep < 5 rows)."""
    return ranking.top_then_exclude(counts.ticker_tag_hourly(event_fact(spark, sf_dir)), ["CLICK"], k=5)


_MDH = f"""
ev_t AS (SELECT month, day, hour, tags, {S.unnest_outer('tickers')} AS tickers FROM ev_fact),
ev_tt AS (SELECT month, day, hour, tickers, {S.unnest_outer('tags')} AS tags FROM ev_t)"""


@query("tag_counts_hour", _with(_MDH) + """
SELECT month, day, hour, tickers, tags, count(tags) AS cnt_t FROM ev_tt GROUP BY month, day, hour, tickers, tags""")
def tag_counts_hour(spark, sf_dir):
    return counts.tag_counts(event_fact(spark, sf_dir), "hour")


@query("tag_counts_day", _with(_MDH) + """
SELECT month, day, tickers, tags, count(tags) AS cnt_t FROM ev_tt GROUP BY month, day, tickers, tags""")
def tag_counts_day(spark, sf_dir):
    return counts.tag_counts(event_fact(spark, sf_dir), "day")


@query("tag_counts_month", _with(_MDH) + """
SELECT month, tickers, tags, count(tags) AS cnt_t FROM ev_tt GROUP BY month, tickers, tags""")
def tag_counts_month(spark, sf_dir):
    return counts.tag_counts(event_fact(spark, sf_dir), "month")


@query("tag_counts_resum", _with(_MDH, """
z AS (SELECT month, day, hour, tickers, tags, count(tags) AS cnt_t FROM ev_tt GROUP BY month, day, hour, tickers, tags)""") + """
SELECT month, day, hour, tickers, tags, CAST(sum(cnt_t) AS BIGINT) AS total FROM z GROUP BY month, day, hour, tickers, tags""")
def tag_counts_resum(spark, sf_dir):
    """Second-level ``sum`` over the hour counts (result order is the consumer's)."""
    return counts.tag_counts_resum(counts.tag_counts(event_fact(spark, sf_dir), "hour"), "hour")


@query("tag_counts_resum_sorted", _with(_MDH, """
z AS (SELECT month, day, hour, tickers, tags, count(tags) AS cnt_t FROM ev_tt GROUP BY month, day, hour, tickers, tags)""") + """
SELECT month, tickers, tags, total, row_number() OVER (ORDER BY total DESC, month, tickers, tags) - 1 AS place FROM (
  SELECT month, tickers, tags, CAST(sum(cnt_t) AS BIGINT) AS total FROM z GROUP BY month, tickers, tags)
WHERE tickers IS NOT NULL AND tags IS NOT NULL""")
def tag_counts_resum_sorted(spark, sf_dir):
    """Month sums of the hour counts, ordered by the sum, largest first; ``place`` is the order."""
    z = counts.tag_counts_resum(counts.tag_counts(event_fact(spark, sf_dir), "hour"), "month")
    z = z.where("tickers IS NOT NULL AND tags IS NOT NULL")
    return numbered(z, F.desc("total"), F.asc("month"), F.asc("tickers"), F.asc("tags"), name="place")


@query("tag_counts_rollup_day", _with(_MDH) + """
SELECT month, day, tickers, tags, count(tags) AS cnt_t FROM ev_tt GROUP BY month, day, tickers, tags""")
def tag_counts_rollup_day(spark, sf_dir):
    """Day counts rolled up from the hour counts instead of re-reading the pairs."""
    return counts.tag_counts_rollup(counts.tag_counts(event_fact(spark, sf_dir), "hour"), "day")


@query("tag_counts_levels", _with(_MDH) + """
SELECT month, day, hour, tickers, tags, CAST(grouping_id(month, day, hour, tickers, tags) AS BIGINT) AS level, count(tags) AS cnt_t
FROM ev_tt GROUP BY GROUPING SETS ((month, day, hour, tickers, tags), (month, day, tickers, tags), (month, tickers, tags))""")
def tag_counts_levels(spark, sf_dir):
    return counts.tag_counts_levels(event_fact(spark, sf_dir))


_FLAT = """
flat AS (SELECT date, month, day, hour, coalesce(array_to_string(tickers, ','), '') AS tickers,
                coalesce(array_to_string(tags, ','), '') AS tags FROM ev_fact),
ex1 AS (SELECT date, month, day, hour, unnest(string_split(tickers, ',')) AS tickers, tags FROM flat),
ex2 AS (SELECT date, month, day, hour, tickers, unnest(string_split(tags, ',')) AS tags FROM ex1),
top_tags AS (
  SELECT tickers, date, month, day, hour, tags, count(tags) AS times FROM ex2
  WHERE tags <> '' AND tags <> tickers GROUP BY tickers, date, month, day, hour, tags
)"""


@query("top_tags", _with(_FLAT) + "SELECT * FROM top_tags")
def top_tags(spark, sf_dir):
    return counts.top_tags(event_fact(spark, sf_dir))


@query("top3_tags_per_hour", _with(_FLAT) + """
SELECT tickers, date, month, day, hour, tags, times, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY tickers, date, hour ORDER BY times DESC, tags ASC NULLS LAST) AS rank FROM top_tags)
WHERE rank <= 3""")
def top3_tags_per_hour(spark, sf_dir):
    return ranking.top_tags_per_hour(counts.top_tags(event_fact(spark, sf_dir)), k=3)


@query("distinct_by_group", _with(_FLAT) + "SELECT DISTINCT tickers, month, day FROM top_tags")
def distinct_by_group(spark, sf_dir):
    """Group-by without aggregate: the (ticker, month, day) keys of the top-tag table."""
    return counts.distinct_by_group(counts.top_tags(event_fact(spark, sf_dir)),
                                    ["tickers", "month", "day"])


@query("distinct_days", _with(_PAIRS_SQL) + """
SELECT DISTINCT CAST(t_hour AS DATE) AS day FROM hourly""")
def distinct_days(spark, sf_dir):
    return counts.ticker_tag_hourly(event_fact(spark, sf_dir)) \
        .select(F.to_date("t_hour").alias("day")).distinct()


@query("time_part_filter", _with() + """
SELECT month, day, hour, coalesce(array_to_string(tickers, ','), '') AS tickers, coalesce(array_to_string(tags, ','), '') AS tags
FROM ev_fact WHERE month <> 10 AND hour = 3""")
def time_part_filter(spark, sf_dir):
    f = counts.flat_posts(event_fact(spark, sf_dir))
    return f.where((F.col("month") != 10) & (F.col("hour") == 3))


@query("row_counts", _with() + """
SELECT 'posts' AS stage, count(*) AS rows FROM ev_fact
UNION ALL SELECT 'tagged', count(*) FROM ev_fact WHERE len(tags) > 0
UNION ALL SELECT 'multi_ticker', count(*) FROM ev_fact WHERE len(tickers) > 1""")
def row_counts(spark, sf_dir):
    """Row counts of the fact and two of its filtered stages, in one pass."""
    f = event_fact(spark, sf_dir)
    return counts.filter_counts(f, {"posts": None, "tagged": F.size("tags") > 0,
                                    "multi_ticker": F.size("tickers") > 1})


@query("tagged_posts", _with() + "SELECT id, CAST(len(tags) AS INTEGER) AS n_tags FROM ev_fact WHERE len(tags) > 0")
def tagged_posts(spark, sf_dir):
    from ..operators.quality import tagged_posts as non_empty
    return non_empty(event_fact(spark, sf_dir), "tags").select("id", F.size("tags").alias("n_tags"))


@query("explode_tickers", _with() + f"""
SELECT id, {S.unnest_outer('tickers')} AS ticker FROM ev_fact""")
def explode_tickers(spark, sf_dir):
    return event_fact(spark, sf_dir).select("id", F.explode_outer("tickers").alias("ticker"))


@query("explode_pairs", _with(_PAIRS_SQL.split("hourly AS")[0].rstrip().rstrip(",")) + """
SELECT CAST(date_trunc('hour', created_at) AS TIMESTAMP) AS t_hour, ticker, tag, count(*) AS n FROM ev_p GROUP BY 1, 2, 3""")
def explode_pairs(spark, sf_dir):
    """Ticker x tag rows per post (cross product inside a post), counted per hour."""
    from ..operators.facts import explode_pairs as pairs
    p = pairs(event_fact(spark, sf_dir))
    return p.groupBy(bucket("created_at", "hour").alias("t_hour"), "ticker", "tag") \
        .agg(F.count(F.lit(1)).alias("n"))


@query("hourly_tags_clean", _with(_PAIRS_SQL) + "SELECT t_hour, tag, ref_tag, cnt FROM hourly WHERE ref_tag <> 'K9'")
def hourly_tags_clean(spark, sf_dir):
    """Count every hourly pair first, then drop NULL parts and a stop tag that occurs
    (the filter on grouping keys is moved below the aggregate by Catalyst)."""
    return counts.clean_hourly(counts.pair_counts_hourly(event_fact(spark, sf_dir)), stop_tag="K9")


@query("drop_self_tags", _with(_FLAT) + """
SELECT month, day, hour, tickers, tags FROM ex2 WHERE tags <> '' AND tags <> tickers""")
def drop_self_tags(spark, sf_dir):
    return counts.drop_self_tags(counts.flat_posts(event_fact(spark, sf_dir)))
