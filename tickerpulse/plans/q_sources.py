"""Registered source queries: envelopes, listing pages, array/string forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import flatten_for_sink, join_array, split_list
from ..functions.timeparts import parse_created_at
from ..operators.facts import expand_metrics, post_fact, tweets_to_posts
from ..operators.identify import identify_and_tag
from ..session import scratch_path
from ..sources import driver_tables as dt
from ..sources import envelopes as env
from ..sources.webpages import page_cells, page_links
from . import sql as S
from .inputs import conversation_posts, event_fact, table
from .registry import query


def _event_envelopes(spark, sf_dir):
    return env.envelopes_from_posts(dt.event_posts(table(spark, sf_dir, "events")))


def _conv_envelopes(spark, sf_dir, users: bool = False):
    posts = conversation_posts(spark, sf_dir)
    if users:  # a user record for every turn, a place for some
        posts = posts.withColumn("users", F.array(F.struct(F.col("author_id").alias("id"), F.lit(None).cast("string").alias("created_at"),
                                                           (F.col("turn") % 2 == 0).alias("verified")))) \
            .withColumn("places", F.when(F.col("turn") % 3 == 0, F.array(F.struct(
                F.lit("p").alias("id"), F.lit("place").alias("full_name"), F.col("author_id").alias("country")))))
    return env.envelopes_from_posts(posts, context_col="tweets")


_ISO = "strftime(created_at, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


@query("flatten_envelope", S.with_(S.CONV_POSTS) + """
SELECT id, author_id, conversation_id, text, list_transform(tweets, lambda t: t.id) AS ref_ids,
       list_transform(tweets, lambda t: t.text) AS ref_texts FROM conv_posts""",
       texts=("ref_ids", "ref_texts"))
def flatten_envelope(spark, sf_dir):
    """Envelopes -> tweet rows with their context array (sentinel dropped)."""
    return env.flatten_envelope(_conv_envelopes(spark, sf_dir)).select(
        "id", "author_id", "conversation_id", "text",
        F.transform("tweets", lambda t: t["id"]).alias("ref_ids"),
        F.transform("tweets", lambda t: t["text"]).alias("ref_texts"))


@query("flatten_no_context", S.with_(S.EV_POSTS) + f"""
SELECT id, author_id, {_ISO} AS created_at, text FROM ev_posts""")
def flatten_no_context(spark, sf_dir):
    return env.flatten_no_context(_event_envelopes(spark, sf_dir)) \
        .select("id", "author_id", "created_at", "text")


@query("long_envelopes", S.with_(S.EV_POSTS) + f"""
SELECT id, author_id, {_ISO} AS created_at, text FROM ev_posts""")
def long_envelopes(spark, sf_dir):
    """Long unclosed one-line documents, each read by many tasks, flattened."""
    path = env.write_long_envelopes(_event_envelopes(spark, sf_dir), scratch_path(spark, "long-envelopes"))
    return env.flatten_no_context(env.read_long_envelopes(spark, path)).select("id", "author_id", "created_at", "text")


@query("ingest_projection", S.with_(S.CONV_POSTS) + """
SELECT id, author_id, conversation_id, text, retweet_count, list_transform(tweets, lambda t: t.id) AS referenced_ids,
       CASE WHEN turn % 2 = 0 THEN ['true'] ELSE ['false'] END AS users_verified,
       CASE WHEN turn % 3 = 0 THEN [author_id] END AS place_countries FROM conv_posts""",
       texts=("referenced_ids", "users_verified", "place_countries"))
def ingest_projection(spark, sf_dir):
    """The collector's field selection over nested tweet records: tweet fields,
    referenced tweets, verified flags of the users, countries of the places."""
    env_df = _conv_envelopes(spark, sf_dir, users=True)
    p = env.ingest_projection(env.explode_tweets(env_df))
    return p.select("id", "author_id", "conversation_id", "text", F.col("public_metrics.retweet_count").alias("retweet_count"),
                    "referenced_ids", F.transform("users_verified", lambda v: v.cast("string")).alias("users_verified"), "place_countries")


@query("expand_metrics", S.with_(S.EV_POSTS) + f"""
SELECT id, author_id, {_ISO} AS created_at, like_count, quote_count, reply_count, retweet_count, text FROM ev_posts""")
def expand_metrics_q(spark, sf_dir):
    """``public_metrics.*`` expanded next to the tweet fields."""
    return expand_metrics(env.flatten_no_context(_event_envelopes(spark, sf_dir)))


@query("parse_created_at", S.with_(S.EV_POSTS) + """
SELECT id, date_trunc('millisecond', created_at) AS created_at FROM ev_posts""")
def parse_created_at_q(spark, sf_dir):
    """ISO creation text (``...T..:..:...SSSZ``) to a UTC timestamp."""
    t = env.flatten_no_context(_event_envelopes(spark, sf_dir))
    return t.select("id", parse_created_at("created_at").alias("created_at"))


@query("post_fact", S.with_(S.EV_POSTS) + """
, u AS (SELECT list(DISTINCT upper(event_type)) AS u FROM events),
p AS (SELECT id, source, author_id, date_trunc('millisecond', created_at) AS created_at,
             like_count, quote_count, reply_count, retweet_count, text FROM ev_posts)
SELECT id, CAST(NULL AS VARCHAR) AS source, author_id, created_at, CAST(created_at AS DATE) AS date,
       CAST(month(created_at) AS INTEGER) AS month, CAST(day(created_at) AS INTEGER) AS day,
       CAST(hour(created_at) AS INTEGER) AS hour, like_count, quote_count, reply_count, retweet_count, text,
       """ + S.keep(S.cands("text"), "u.u") + " AS tickers, " + S.tags("text") + """ AS tags
FROM p, u""", texts=("tickers", "tags"))
def post_fact_q(spark, sf_dir):
    """Envelope tweets -> parsed, identified, tagged post fact with time parts."""
    tweets = env.flatten_envelope(_event_envelopes(spark, sf_dir))
    posts = tweets_to_posts(tweets)
    u = dt.event_symbols(table(spark, sf_dir, "events"))
    return post_fact(identify_and_tag(posts, u, context_col="tweets"))


@query("read_envelopes", S.with_(S.EV_POSTS) + f"""
SELECT id, author_id, {_ISO} AS created_at, text FROM ev_posts""")
def read_envelopes(spark, sf_dir):
    """Write line-delimited envelopes to the shared scratch folder, read them
    back with the explicit schema, re-close unclosed documents, flatten."""
    path = scratch_path(spark, "envelopes")
    _event_envelopes(spark, sf_dir).write.mode("overwrite").json(path)
    back = env.repair_unclosed(env.read_envelopes(spark, path, multi_line=False))
    return env.flatten_no_context(back).select("id", "author_id", "created_at", "text")


@query("page_links", S.with_(S.PG_LINKS) + "SELECT page_id, pos, link FROM pg_links")
def page_links_q(spark, sf_dir):
    """Every second listing anchor of each page (the symbol of each name/symbol pair)."""
    return page_links(table(spark, sf_dir, "pages"))


_CELL_RE = '<li><a href="[^"]*">([^<]*)</a></li>'
_SENTINEL = "the"  # a cell text that pages have


@query("page_cells", f"""
WITH c AS (SELECT page_id, regexp_extract_all(html, '{_CELL_RE}', 1) AS cells FROM pages),
k AS (SELECT page_id, CASE WHEN coalesce(list_position(cells, '{_SENTINEL}'), 0) > 0
                           THEN cells[1:list_position(cells, '{_SENTINEL}') - 1] ELSE cells END AS kept FROM c),
r AS (SELECT page_id, kept, unnest(range(0, CAST(ceil(len(kept) / 3) AS BIGINT))) AS rec FROM k)
SELECT page_id, rec, kept[rec * 3 + 1] AS price, kept[rec * 3 + 2] AS chg, kept[rec * 3 + 3] AS pct_chg FROM r""")
def page_cells_q(spark, sf_dir):
    """List-item cells of each page, cut at the sentinel cell, de-interleaved
    by stride 3 into (price, chg, pct_chg) records."""
    return page_cells(table(spark, sf_dir, "pages"), _CELL_RE, _SENTINEL)


@query("array_string_roundtrip", S.with_(S.EV_POSTS) + """
SELECT id, coalesce(array_to_string(tags, ','), '') AS tags_text,
       string_split(coalesce(array_to_string(tags, ','), ''), ',') AS tags_back FROM ev_fact""",
       texts=("tags_back",))
def array_string_roundtrip(spark, sf_dir):
    f = event_fact(spark, sf_dir)
    s = f.select("id", join_array("tags").alias("tags_text"))
    return s.withColumn("tags_back", split_list("tags_text"))


@query("flatten_for_sink", S.with_(S.EV_POSTS) + """
SELECT id, coalesce(array_to_string(tickers, ','), '') AS tickers, coalesce(array_to_string(tags, ','), '') AS tags,
       retweet_count FROM ev_fact""")
def flatten_for_sink_q(spark, sf_dir):
    """Every array column joined to a comma string (found from the schema)."""
    f = event_fact(spark, sf_dir).select("id", "tickers", "tags", "retweet_count")
    return flatten_for_sink(f)
