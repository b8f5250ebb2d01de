"""Post fact and mention rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeparts import parse_created_at, time_parts


def expand_metrics(tweets: DataFrame) -> DataFrame:
    """Star-expand ``public_metrics`` next to the tweet's own fields."""
    return tweets.select("id", "author_id", "created_at", "public_metrics.*", "text")


def tweets_to_posts(tweets: DataFrame, source: str | Column | None = None) -> DataFrame:
    """Flattened tweets (``data.*`` + ``tweets`` context) to the flat post
    shape the identification step takes (created_at parsed to UTC)."""
    return tweets.select(
        "id", (source if isinstance(source, Column) else F.lit(source)).cast("string").alias("source"), "author_id",
        parse_created_at("created_at").alias("created_at"),
        "public_metrics.*", "text", "tweets")


def post_fact(posts: DataFrame) -> DataFrame:
    """Identified posts -> the published post fact with year-less parts.

    Columns: id, source, author_id, created_at, date, month, day, hour,
    the four counters, text, tickers, tags.
    """
    p = time_parts("created_at")
    return posts.select(
        "id", "source", "author_id", "created_at", p["date"].alias("date"), p["month"].alias("month"),
        p["day"].alias("day"), p["hour"].alias("hour"),
        "like_count", "quote_count", "reply_count", "retweet_count",
        "text", "tickers", "tags")


def union_sources(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; a missing column on one side becomes NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def explode_tickers(fact: DataFrame, keep_cols=("created_at", "retweet_count")) -> DataFrame:
    """One row per (post, ticker); posts without tickers keep one NULL row."""
    return fact.select(*keep_cols, F.explode_outer("tickers").alias("ticker"))


def explode_pairs(fact: DataFrame, keep_cols=("created_at",)) -> DataFrame:
    """Ticker x tag rows of each post (the per-post cross product), NULLs kept.

    Only the needed columns are carried through the two generators.
    """
    t = fact.select(*keep_cols, "tags", F.explode_outer("tickers").alias("ticker"))
    return t.select(*keep_cols, "ticker", F.explode_outer("tags").alias("tag"))
