"""Explicit schemas: inference would cost a full extra pass over the input
and breaks unions when one file carries an extra nested field."""

from __future__ import annotations

from pyspark.sql import types as T

METRICS = T.StructType([
    T.StructField("like_count", T.LongType()),
    T.StructField("quote_count", T.LongType()),
    T.StructField("reply_count", T.LongType()),
    T.StructField("retweet_count", T.LongType()),
])

TWEET_DATA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("author_id", T.StringType()),
    T.StructField("conversation_id", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("public_metrics", METRICS),
])

REF_TWEET = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("text", T.StringType()),
])

USER = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("verified", T.BooleanType()),
])

PLACE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("full_name", T.StringType()),
    T.StructField("country", T.StringType()),
])

INCLUDES = T.StructType([
    T.StructField("tweets", T.ArrayType(REF_TWEET)),
    T.StructField("users", T.ArrayType(USER)),
    T.StructField("places", T.ArrayType(PLACE)),
])

TWEET = T.StructType([
    T.StructField("data", TWEET_DATA),
    T.StructField("includes", INCLUDES),
])

# One envelope document: {"tweets": [t1, t2, ..., {}]}; _corrupt_record
# catches files a killed writer left unclosed.
ENVELOPE_BODY = T.StructType([T.StructField("tweets", T.ArrayType(TWEET))])
ENVELOPE = T.StructType(ENVELOPE_BODY.fields + [T.StructField("_corrupt_record", T.StringType())])

# Raw price bar as written by the price collector.
BAR_RAW = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

# The published post fact.
FACT = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("source", T.StringType()), T.StructField("author_id", T.StringType()),
     T.StructField("created_at", T.TimestampNTZType()), T.StructField("date", T.DateType())]
    + [T.StructField(part, T.IntegerType()) for part in ("month", "day", "hour")]
    + METRICS.fields
    + [T.StructField("text", T.StringType()), T.StructField("tickers", T.ArrayType(T.StringType())),
       T.StructField("tags", T.ArrayType(T.StringType()))])
