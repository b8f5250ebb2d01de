"""Registered sink queries: publish, read back, parameterised SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import counts, market, ranking
from ..operators.upsert import upsert_posts
from ..session import scratch_path, staged
from ..sinks.tables import (publish_all, read_table, write_bars_json, write_rolled,
                            write_table)
from ..sinks.versions import publish_version, read_published
from ..sources import driver_tables as dt
from ..sources.bars import normalise_daily, normalise_hourly, read_bars
from ..streaming.days import read_days
from . import sql as S
from .inputs import event_fact, table
from .q_counts import _DAILY_SQL, _FLAT, _PAIRS_SQL
from .q_market import _DAILY, _HOURLY, _TICKS
from .registry import query


# the pair fragment reuses a CTE name of the daily one
_PAIRS_ONLY = _PAIRS_SQL.replace("ev_m AS", "ev_m2 AS").replace("FROM ev_m)", "FROM ev_m2)")

_J = "coalesce(array_to_string({0}, ','), '')"
_SETS = f"{_J.format('tickers')} AS tickers, {_J.format('tags')} AS tags"
_METRICS = "like_count, quote_count, reply_count, retweet_count"

#: table -> (rows of it, integer columns, text columns)
_PUBLISHED = {
    "timing_union_df": (f"SELECT month, day, hour, {_METRICS}, text, {_SETS} FROM ev_fact",
                        f"month, day, hour, {_METRICS}", "text, tickers, tags"),
    "posts": (f"SELECT id, source, author_id, month, day, hour, {_METRICS}, text, {_SETS} FROM ev_fact",
              f"month, day, hour, {_METRICS}", "id, source, author_id, text, tickers, tags"),
    "timing_time_tickers_tags_df": (f"SELECT month, day, hour, {_SETS} FROM ev_fact", "month, day, hour", "tickers, tags"),
    "mdhr_tags": (f"SELECT month, day, hour, {_SETS} FROM ev_fact", "month, day, hour", "tickers, tags"),
    "top_tags": ("SELECT * FROM top_tags", "month, day, hour, times", "tickers, tags"),
    "top5_stock_statistics_new": (f"""SELECT t AS tickers, count(*) AS cnt, sum(retweet_count) AS retweets, count(*) + sum(retweet_count) AS final_result
        FROM (SELECT {S.unnest_outer('tickers')} AS t, retweet_count FROM ev_fact) GROUP BY t""", "cnt, retweets, final_result", "tickers"),
    "tag_freq_new": (f"""SELECT upper(t) AS ticker, count(*) AS cnt FROM (SELECT {S.unnest_outer('tickers')} AS t FROM ev_fact)
        GROUP BY 1 ORDER BY cnt DESC, ticker ASC NULLS LAST LIMIT 5""", "cnt", "ticker"),
    "test_days_list": ("SELECT t_day, sum(cnt) AS cnt FROM daily GROUP BY t_day", "cnt", ""),
    "popular_tags_daily_count_new": ("""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t_day ORDER BY cnt DESC, tag ASC NULLS LAST) AS rank
        FROM daily) WHERE rank <= 5""", "cnt, rank", "tag"),
    "popular_tags_hourly_count_new": ("""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t_hour ORDER BY cnt DESC, tag ASC NULLS LAST,
        ref_tag ASC NULLS LAST) AS rank FROM hourly) WHERE rank <= 5""", "cnt, rank", "tag, ref_tag"),
    "timing_ticker_freq_df": (f"SELECT {_J.format('tickers')} AS tickers, count(*) AS cnt FROM ev_fact GROUP BY ev_fact.tickers", "cnt", "tickers"),
    "timing_time_tickers_tags_explode_df": ("""SELECT month, day, hour, ticker AS tickers, tag AS tags FROM ev_mdh""",
                                            "month, day, hour", "tickers, tags"),
}


def _sums(names: str, each: str) -> str:
    return " + ".join(f"coalesce({each.format(n.strip())}, 0)" for n in names.split(",") if n.strip()) or "0"


_PUBLISH_SQL = S.with_(S.EV_POSTS, _DAILY_SQL, _PAIRS_ONLY, _FLAT, f"""
ev_mdh1 AS (SELECT month, day, hour, tags, {S.unnest_outer('tickers')} AS ticker FROM ev_fact),
ev_mdh AS (SELECT month, day, hour, ticker, {S.unnest_outer('tags')} AS tag FROM ev_mdh1)""") + "\nUNION ALL ".join(
    f"""SELECT '{name}' AS "table", count(*) AS rows, CAST(sum({_sums(nums, '{0}')}) AS BIGINT) AS numbers,
    CAST(sum({_sums(texts, 'length({0})')}) AS BIGINT) AS chars FROM ({rows}) AS {name}"""
    for name, (rows, nums, texts) in _PUBLISHED.items())


def _content(df, name: str):
    """Rows of a table, the sum of its integers and the length of its texts."""
    nums = [F.coalesce(F.col(f.name).cast("bigint"), F.lit(0)) for f in df.schema.fields if f.dataType.typeName() in ("integer", "long")]
    texts = [F.coalesce(F.length(F.array_join(f.name, ",") if f.dataType.typeName() == "array" else F.col(f.name)), F.lit(0))
             for f in df.schema.fields if f.dataType.typeName() in ("string", "array")]
    total = lambda cols: F.sum(reduce(lambda a, b: a + b, cols, F.lit(0).cast("bigint")))
    return df.agg(F.count(F.lit(1)).alias("rows"), total(nums).alias("numbers"), total(texts).alias("chars")) \
        .select(F.lit(name).alias("table"), "rows", "numbers", "chars")


@query("publish_all", _PUBLISH_SQL)
def publish_all_q(spark, sf_dir):
    """Publish the whole table set from one staged post fact, then read every
    table back and report its rows, the sum of its integers and the length of its texts."""
    base = scratch_path(spark, "published")
    paths = publish_all(event_fact(spark, sf_dir), base)
    return reduce(lambda a, b: a.unionByName(b), [_content(read_table(spark, n, base), n) for n in paths])


@query("posts_published", S.with_(S.EV_POSTS) + """
SELECT id, text, coalesce(array_to_string(tickers, ','), '') AS tickers,
       coalesce(array_to_string(tags, ','), '') AS tags FROM ev_fact""")
def posts_published(spark, sf_dir):
    """Raw posts with their id, arrays joined for a flat store, written and read back."""
    base = scratch_path(spark, "posts")
    f = event_fact(spark, sf_dir).select("id", "text", "tickers", "tags")
    write_table(f, "posts", base)
    return read_table(spark, "posts", base)


@query("published_roundtrip", S.with_(S.EV_POSTS) + """
SELECT month, day, hour, coalesce(array_to_string(tickers, ','), '') AS tickers,
       coalesce(array_to_string(tags, ','), '') AS tags FROM ev_fact""")
def published_roundtrip(spark, sf_dir):
    """The flat post table (month, day, hour, tickers, tags) through the table store."""
    base = scratch_path(spark, "mdhr")
    write_table(counts.flat_posts(event_fact(spark, sf_dir)), "mdhr_tags", base)
    return read_table(spark, "mdhr_tags", base)


@query("sql_over_published", S.with_(S.EV_POSTS, _DAILY_SQL) + """
SELECT t_day, tag, cnt, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY t_day ORDER BY cnt DESC, tag ASC NULLS LAST) AS rank FROM daily)
WHERE rank <= 5 AND tag = 'VIEW'""")
def sql_over_published(spark, sf_dir):
    """Bound-parameter SQL over a published table (no text pasting of values)."""
    base = scratch_path(spark, "daily")
    top = ranking.top_daily(counts.ticker_daily_count(event_fact(spark, sf_dir)), k=5)
    write_table(top, "popular_tags_daily_count_new", base)
    read_table(spark, "popular_tags_daily_count_new", base).createOrReplaceTempView("popular_daily")
    return spark.sql("SELECT t_day, tag, cnt, rank FROM popular_daily WHERE tag = :tag",
                     args={"tag": "VIEW"})


@query("write_bars_json", S.with_(_HOURLY) + "SELECT * FROM hourly")
def write_bars_json_q(spark, sf_dir):
    """Hourly bars written as line-delimited JSON in the collector's text
    shape, read back with the bar schema and normalised."""
    path = scratch_path(spark, "bars-json")
    bars = market.hourly_bars(dt.event_ticks(table(spark, sf_dir, "events")))
    write_bars_json(market.raw_hourly_bars(bars), path)
    return normalise_hourly(read_bars(spark, path))


@query("write_rolled", S.with_(S.EV_POSTS) + """
SELECT date, count(*) AS rows, CAST(sum(like_count) AS BIGINT) AS likes, CAST(sum(length(text)) AS BIGINT) AS chars
FROM ev_fact GROUP BY date""")
def write_rolled_q(spark, sf_dir):
    """Post fact as JSON files rolled at a byte size in date folders; rows and sums per date read back."""
    path = scratch_path(spark, "rolled")
    fact = event_fact(spark, sf_dir).select("id", "text", "like_count", "date")
    write_rolled(fact, path)
    return spark.read.schema(fact.schema).json(path).groupBy("date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("like_count").alias("likes"), F.sum(F.length("text")).alias("chars"))


@query("read_bars", S.with_(_TICKS, _DAILY) + "SELECT * FROM daily")
def read_bars_q(spark, sf_dir):
    """Daily bars in the collector's JSON shape read with the explicit bar
    schema (no inference) and normalised to typed, year-less keys."""
    path = scratch_path(spark, "daily-bars-json")
    daily = market.daily_bars(dt.event_ticks(table(spark, sf_dir, "events")))
    raw = daily.select("ticker", F.date_format("date", "yyyy-MM-dd").alias("date"),
                       F.lit(None).cast("string").alias("time"),
                       "open", "high", "low", "close", "volume")
    write_bars_json(raw, path)
    return normalise_daily(read_bars(spark, path))


@query("publish_versions", S.with_(S.EV_POSTS, _DAILY_SQL) + "SELECT t_day, CAST(sum(cnt) AS BIGINT) AS cnt FROM daily GROUP BY t_day")
def publish_versions(spark, sf_dir):
    """Daily totals out of the current version of a table set, after a later run that failed half way."""
    base = scratch_path(spark, "versions")
    fact = event_fact(spark, sf_dir)

    def whole(folder):
        posts = write_table(fact.select("id", "date", "tickers", "created_at"), "posts", folder, flatten=False)
        return {"posts": posts, "test_days_list": write_table(counts.daily_total(spark.read.parquet(posts)), "test_days_list", folder)}

    def killed(folder):
        write_table(read_published(spark, base, "test_days_list").limit(0), "test_days_list", folder)
        raise RuntimeError("killed")
    publish_version(spark, base, whole)
    try:
        publish_version(spark, base, killed)
    except RuntimeError as e:
        if str(e) != "killed":
            raise
    return read_published(spark, base, "test_days_list")


@query("upsert_posts", S.with_(S.EV_POSTS) + """, seen AS (
SELECT id, date, like_count, created_at AS seen_at, 'cashtag' AS source FROM ev_fact UNION ALL
SELECT id, date, like_count + 1, created_at + INTERVAL 1 HOUR, 'hashtag' FROM ev_fact WHERE like_count % 2 = 0),
last AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seen_at DESC) AS rn FROM seen)
SELECT last.id, last.date, last.like_count, last.seen_at, s.sources FROM last
JOIN (SELECT id, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM seen GROUP BY id) s ON s.id = last.id WHERE rn = 1""")
def upsert_posts_q(spark, sf_dir):
    """Posts met by one collector, then some of them by the other an hour later, then the first again: one row each."""
    path = scratch_path(spark, "upserted")
    posts = event_fact(spark, sf_dir).select("id", "date", "like_count", F.col("created_at").alias("seen_at"))
    first = staged(posts.withColumn("sources", F.array(F.lit("cashtag"))), "upsert-first")
    later = staged(first.where("like_count % 2 = 0").withColumn("like_count", F.col("like_count") + 1)
                   .withColumn("seen_at", F.col("seen_at") + F.expr("INTERVAL 1 HOUR"))
                   .withColumn("sources", F.array(F.lit("hashtag"))), "upsert-later")
    for n, rows in enumerate((first, later, first)):
        upsert_posts(rows, path, n)
    return read_days(spark, path, first.schema, "date").withColumn("sources", F.array_join("sources", ","))
