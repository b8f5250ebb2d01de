"""Stand-in inputs built from the driver's tables.

These functions only give rows in the shapes the jobs expect (posts with
text, price ticks, listing pages); identification, tag extraction,
filtering, counting and ranking all run afterwards through the library.

* ``event_posts``: one post per (user, day) of ``events``. Its text holds
  the day's distinct ``$TYPE`` and ``#K<k>`` tokens, so the per-post state
  is bounded by the number of distinct tokens, never by the group size.
* ``event_ticks``: one price tick per event (symbol = upper event type).
* ``tagged_text``: words of six or more letters of a prose text get a
  ``#`` in front, which makes them hashtags and symbol candidates.
* ``conversation_posts`` / ``document_posts``: one post per turn /
  document with tagged text; a turn's context is the turn it answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import left_join_skip_nulls

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

TAG_WORD = "(\\p{L}{6,})"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tagged_text(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, TAG_WORD, "#$1")


def event_posts(events: DataFrame, source: str = "cashtag") -> DataFrame:
    """Posts in the collector's flat shape: id, source, author_id,
    created_at (timestamp_ntz), the four counters and text. Their symbols
    carry ``$``, so they are what the cashtag collector's rules catch."""
    k = F.get_json_object("props", "$.k")
    sym_tok = F.concat(F.lit("$"), F.upper("event_type"))
    tag_tok = F.concat(F.lit("#K"), k)
    day = F.to_date("ts")
    g = events.groupBy("user_id", day.alias("d")).agg(
        F.min("ts").alias("created_at"),
        F.sum(F.floor("value")).cast("bigint").alias("like_count"),
        F.min(F.floor("value")).cast("bigint").alias("quote_count"),
        F.max(F.floor("value")).cast("bigint").alias("reply_count"),
        F.count(F.lit(1)).alias("retweet_count"),
        F.collect_set(sym_tok).alias("s"),
        F.collect_set(tag_tok).alias("t"),
    )
    return g.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("d", "yyyyMMdd")).alias("id"),
        F.lit(source).alias("source"),
        F.col("user_id").cast("string").alias("author_id"),
        "created_at", "like_count", "quote_count", "reply_count", "retweet_count",
        F.array_join(F.array_sort(F.array_union("s", "t")), " ").alias("text"),
    )


def event_symbols(events: DataFrame) -> DataFrame:
    """Symbol dimension of the event posts: distinct upper event types."""
    return events.select(F.upper("event_type").alias("symbol")).distinct()


def event_ticks(events: DataFrame) -> DataFrame:
    """Price ticks: ticker, ts, price, seq (tie-breaker), size."""
    return events.select(
        F.upper("event_type").alias("ticker"), "ts", F.col("value").alias("price"),
        F.col("event_id").alias("seq"), F.lit(1.0).alias("size"))


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """One post per turn (id, conversation_id, text) without the answered turn."""
    return conversations.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.col("conv_id").cast("string").alias("conversation_id"),
        tagged_text("text").alias("text"))


def conversation_posts(conversations: DataFrame) -> DataFrame:
    """One post per turn; ``tweets`` holds the answered turn (NULL for the first).

    The answered turn is found by an equi-join on (conv_id, turn), which
    spreads a long conversation over many keys instead of one window task.
    """
    c = conversations.select("conv_id", "turn", "role", tagged_text("text").alias("text"))
    prev = c.select("conv_id", (F.col("turn") + 1).alias("turn"),
                    F.struct(F.concat_ws("-", F.col("conv_id").cast("string"),
                                         F.col("turn").cast("string")).alias("id"),
                             F.col("text").alias("text")).alias("ref"))
    j = left_join_skip_nulls(c, prev, ["conv_id", "turn"])
    return j.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.lit("conversations").alias("source"),
        F.col("role").alias("author_id"),
        F.col("conv_id").cast("string").alias("conversation_id"),
        F.col("turn").alias("turn"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(0).cast("bigint").alias("like_count"),
        F.lit(0).cast("bigint").alias("quote_count"),
        F.lit(0).cast("bigint").alias("reply_count"),
        F.col("turn").cast("bigint").alias("retweet_count"),
        "text",
        F.when(F.col("ref").isNotNull(), F.array("ref")).alias("tweets"),
    )


def document_posts(documents: DataFrame) -> DataFrame:
    """One post per document with tagged text; ``source`` kept for unions."""
    return documents.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source"),
        F.col("lang").alias("author_id"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(0).cast("bigint").alias("like_count"),
        F.lit(0).cast("bigint").alias("quote_count"),
        F.lit(0).cast("bigint").alias("reply_count"),
        F.col("n_chars").cast("bigint").alias("retweet_count"),
        tagged_text("text").alias("text"),
    )


def cash_tagged_text(c) -> Column:
    """Words of six or more letters get a ``$`` in front (cashtag form)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, TAG_WORD, "\\$$1")
