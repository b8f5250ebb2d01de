"""Tweet envelope files: read, flatten, project.

An envelope is one JSON document ``{"tweets": [t1, ..., {}]}``; the last
element is an empty-object sentinel. Multi-line documents are one task per
file, so the ingest rolls files at a bounded size; line-delimited
envelopes (one document per line, ``multi_line=False``) split freely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def read_envelopes(spark: SparkSession, path: str, multi_line: bool = True,
                   path_glob: str | None = None) -> DataFrame:
    """Read envelope files with the explicit schema (no inference pass).

    PERMISSIVE mode keeps unreadable documents as one row whose
    ``_corrupt_record`` holds the text and whose ``tweets`` is NULL.
    """
    r = (spark.read.schema(schemas.ENVELOPE)
         .option("multiLine", multi_line)
         .option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", "_corrupt_record"))
    if path_glob:
        r = r.option("pathGlobFilter", path_glob)
    return r.json(path)


#: What a record of an envelope begins with; inside a JSON string its quotes would be escaped.
RECORD_START = '{"data":'


def read_long_envelopes(spark: SparkSession, path: str, path_glob: str | None = None) -> DataFrame:
    """Documents of any length, also on one line without line breaks, read by many tasks: a row of ``read_envelopes``' shape per record.

    The text source cuts files at ``{"data":``, wherever a split begins, so a
    document is spread over tasks like any splittable file and a task holds one
    record at a time. Each piece is closed and parsed as an envelope of its own,
    what follows its records' end (a sentinel, the document's closing brackets)
    going with the last one. Unclosed documents need no repair; of one cut
    inside a record only that record is unreadable and stays in
    ``_corrupt_record``. Records must begin with ``data``, without blanks up to
    the colon, as collectors write them.
    """
    r = spark.read.option("lineSep", RECORD_START)
    if path_glob:
        r = r.option("pathGlobFilter", path_glob)
    head = F.col("value").rlike(r'^\s*\{\s*"tweets"\s*:')
    body = F.regexp_replace("value", r",\s*$", "")
    whole = F.concat(F.when(head, body).otherwise(F.concat(F.lit('{"tweets":[' + RECORD_START), body)), F.lit("]}"))
    pieces = r.text(path).where(F.trim("value") != "").select(F.from_json(whole, schemas.ENVELOPE_BODY)["tweets"].alias("tweets"), "value")
    corrupt = F.when(F.col("tweets").isNull(), F.col("value")).alias("_corrupt_record")
    return pieces.select("tweets", corrupt).where((F.size("tweets") > 0) | F.col("tweets").isNull())


def write_long_envelopes(env: DataFrame, path: str) -> str:
    """Envelopes as one long document a task, on one line and never closed: what a collector that was
    killed between two records leaves. Nothing is gathered, each record is written as it comes."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # the lower 33 bits count within the task
    record = F.to_json(F.col("col"))
    numbered = explode_tweets(env).select(F.concat(F.when(first, F.lit('{"tweets": [')).otherwise(F.lit("")), record).alias("value"))
    numbered.write.mode("overwrite").option("lineSep", ", ").text(path)
    return path


def corrupt_files(env: DataFrame) -> DataFrame:
    """Rows of documents that did not parse (for counting / repair)."""
    return env.where(F.col("tweets").isNull() & F.col("_corrupt_record").isNotNull()) \
        .select("_corrupt_record")


def repair_unclosed(env: DataFrame) -> DataFrame:
    """Envelopes with unreadable documents re-parsed after closing them.

    A writer killed between records leaves ``{"tweets":[t1,...,tn,``; adding
    the sentinel and the closing brackets makes it whole again. Documents
    cut inside a record stay unreadable and keep their ``_corrupt_record``.
    Every row is handled on its own, so repair runs in the reading tasks.
    """
    bad = F.col("tweets").isNull() & F.col("_corrupt_record").isNotNull()
    closed = F.concat(F.regexp_replace(F.col("_corrupt_record"), r",\s*$", ","), F.lit("{}]}"))
    fixed = F.from_json(closed, schemas.ENVELOPE_BODY)
    tweets = F.when(bad, fixed["tweets"]).otherwise(F.col("tweets"))
    still_bad = F.when(bad & fixed["tweets"].isNull(), F.col("_corrupt_record"))
    return env.withColumns({"tweets": tweets, "_corrupt_record": still_bad})


def explode_tweets(env: DataFrame, keep_sentinel: bool = False) -> DataFrame:
    """One row per array element; the ``{}`` sentinel is dropped unless asked."""
    out = env.select(F.explode("tweets").alias("col"))
    if not keep_sentinel:
        out = out.where(F.col("col.data.id").isNotNull())
    return out


def flatten_envelope(env: DataFrame, keep_sentinel: bool = False) -> DataFrame:
    """Envelope rows to tweet rows: ``data.*`` plus the context ``includes.tweets``."""
    return explode_tweets(env, keep_sentinel).select("col.data.*", "col.includes.tweets")


def flatten_no_context(env: DataFrame, keep_sentinel: bool = False) -> DataFrame:
    """Envelope rows to tweet rows without the context array."""
    return explode_tweets(env, keep_sentinel).select("col.data.*")


def ingest_projection(tweets: DataFrame) -> DataFrame:
    """The collector's field selection from tweet records (``col`` struct rows):
    tweet fields, the referenced tweets, author and place summaries."""
    c = F.col("col")
    return tweets.select(
        c["data"]["id"].alias("id"),
        c["data"]["text"].alias("text"),
        c["data"]["author_id"].alias("author_id"),
        c["data"]["conversation_id"].alias("conversation_id"),
        c["data"]["created_at"].alias("created_at"),
        c["data"]["public_metrics"].alias("public_metrics"),
        F.transform(c["includes"]["tweets"], lambda t: t["id"]).alias("referenced_ids"),
        F.transform(c["includes"]["users"], lambda u: u["verified"]).alias("users_verified"),
        F.transform(c["includes"]["places"], lambda p: p["country"]).alias("place_countries"),
    )


def tweet_struct(id_: Column, text: Column, author_id: Column, conversation_id: Column,
                 created_at: Column, like: Column, quote: Column, reply: Column,
                 retweet: Column, context: Column, users: Column | None = None, places: Column | None = None) -> Column:
    """Build one envelope element in the collector's nested shape."""
    return F.struct(
        F.struct(
            id_.cast("string").alias("id"), text.alias("text"),
            author_id.cast("string").alias("author_id"),
            conversation_id.cast("string").alias("conversation_id"),
            created_at.alias("created_at"),
            F.struct(like.cast("bigint").alias("like_count"),
                     quote.cast("bigint").alias("quote_count"),
                     reply.cast("bigint").alias("reply_count"),
                     retweet.cast("bigint").alias("retweet_count")).alias("public_metrics"),
        ).alias("data"),
        F.struct(
            context.alias("tweets"),
            (F.lit(None) if users is None else users).cast("array<struct<id:string,created_at:string,verified:boolean>>").alias("users"),
            (F.lit(None) if places is None else places).cast("array<struct<id:string,full_name:string,country:string>>").alias("places"),
        ).alias("includes"),
    )


ISO_OUT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def envelopes_from_posts(posts: DataFrame, context_col: str | None = None) -> DataFrame:
    """One line-delimited envelope per post: ``{"tweets": [post, {}]}``.

    Posts in the flat shape (id, author_id, created_at timestamp_ntz, the
    four counters, text, optional conversation_id / context array) are put
    back into the collector's nested shape, sentinel included. One post
    per envelope keeps every document small and the files splittable.
    """
    conv = F.col("conversation_id") if "conversation_id" in posts.columns else F.col("author_id")
    ctx = F.col(context_col) if context_col else F.lit(None).cast("array<struct<id:string,text:string>>")
    created = F.date_format(F.col("created_at"), ISO_OUT)
    t = tweet_struct(F.col("id"), F.col("text"), F.col("author_id"), conv, created,
                     F.col("like_count"), F.col("quote_count"), F.col("reply_count"),
                     F.col("retweet_count"), ctx, *[F.col(c) if c in posts.columns else None for c in ("users", "places")])
    # The sentinel is a struct whose fields are all NULL: JSON writes it as {}.
    sentinel = F.struct(F.lit(None).cast(schemas.TWEET_DATA).alias("data"),
                        F.lit(None).cast(schemas.INCLUDES).alias("includes"))
    return posts.select(F.array(t, sentinel).alias("tweets"))
