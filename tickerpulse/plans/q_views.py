"""Registered consumer views: dense grids and long measures."""

from __future__ import annotations

from ..operators import counts, ranking, views
from . import sql as S
from .inputs import event_fact
from .q_counts import _DAILY_SQL, _PAIRS_SQL, _TOP_HOURLY
from .registry import query


@query("leader_cube", S.with_(S.EV_POSTS, _PAIRS_SQL, "ranked AS (" + _TOP_HOURLY + ")") + """
, leaders AS (SELECT t_hour, tag || '•' || ref_tag AS stock, cnt FROM ranked WHERE rank = 1),
rng AS (SELECT date_trunc('day', min(t_hour)) AS lo, date_trunc('day', max(t_hour)) - INTERVAL 1 DAY + INTERVAL 23 HOUR AS hi FROM leaders),
hours AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS TIMESTAMP) AS t_hour FROM rng)
SELECT h.t_hour, CAST(h.t_hour AS DATE) AS day, CAST(hour(h.t_hour) AS INTEGER) AS hour, l.stock, coalesce(l.cnt, 0) AS cnt
FROM hours h LEFT JOIN leaders l USING (t_hour)""")
def leader_cube(spark, sf_dir):
    """Dense day x hour grid of the hourly leader (last partial day dropped)."""
    ranked = ranking.top_hourly_tags(counts.ticker_tag_hourly(event_fact(spark, sf_dir)), k=5)
    return views.leader_cube(ranking.hour_leader_label(ranked))


@query("daily_frames", S.with_(S.EV_POSTS, _DAILY_SQL) + """
, top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t_day ORDER BY cnt DESC, tag ASC NULLS LAST) AS rank
                         FROM daily) WHERE rank <= 5),
rng AS (SELECT min(t_day) AS lo, max(t_day) - INTERVAL 1 DAY AS hi FROM top),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS TIMESTAMP) AS t_day FROM rng),
slots AS (SELECT t_day, unnest(range(1, 6)) AS rank FROM days)
SELECT s.t_day, s.rank, t.tag, coalesce(t.cnt, 0) AS cnt FROM slots s LEFT JOIN top t USING (t_day, rank)""")
def daily_frames(spark, sf_dir):
    """Five rank slots per calendar day, filled from the daily top-5 by key."""
    top = ranking.top_daily(counts.ticker_daily_count(event_fact(spark, sf_dir)), k=5)
    return views.daily_frames(top, k=5)


@query("measures_long", S.with_(S.EV_POSTS) + f"""
, ev_m AS (SELECT retweet_count, {S.unnest_outer('tickers')} AS ticker FROM ev_fact),
st AS (SELECT coalesce(ticker, '') AS tickers, count(*) AS cnt, CAST(sum(retweet_count) AS BIGINT) AS retweets,
              CAST(count(*) + sum(retweet_count) AS BIGINT) AS final_result FROM ev_m GROUP BY ticker)
UNPIVOT st ON cnt, retweets, final_result INTO NAME measure VALUE value""")
def measures_long(spark, sf_dir):
    """The three per-ticker measures as (tickers, measure, value) rows."""
    return views.measures_long(counts.ticker_statistics(event_fact(spark, sf_dir)))
