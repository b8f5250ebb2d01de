"""Registered streaming queries, run with ``availableNow`` over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ranking
from ..operators import rules as R
from ..operators.identify import identify_and_tag, symbol_table
from ..session import scratch_path
from ..sources import driver_tables as dt
from ..sources import envelopes as env
from ..streaming import jobs
from . import sql as S
from .inputs import page_universe, table
from .q_text import _LISTING_SQL, _listing
from .registry import query

DOC = S.with_(S.PG_UNIVERSE, S.DOC_FACT)


@query("stream_identify", DOC + "SELECT id, tickers, tags FROM doc_fact", texts=("tickers", "tags"))
def stream_identify(spark, sf_dir):
    """Documents as a stream: each micro-batch is identified against the
    listing symbols (a join) and tagged; checkpointed."""
    universe = symbol_table(page_universe(spark, sf_dir))  # stored: micro-batches do not read the pages again
    posts = dt.document_posts(jobs.table_stream(spark, sf_dir, "documents"))
    return jobs.run_available_now(posts, "stream-identify", per_batch=lambda b: identify_and_tag(b, universe)
                                  .select("id", "tickers", "tags"))


_MENTIONS = """
m AS (SELECT upper(event_type) AS ticker, ts FROM events),
c AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS t_hour, ticker, count(*) AS cnt FROM m GROUP BY 1, 2)"""


def _mention_stream(spark, sf_dir):
    ev = jobs.table_stream(spark, sf_dir, "events")
    return ev.select(F.upper("event_type").alias("ticker"), F.col("ts").alias("created_at"))


@query("stream_hourly_counts", S.with_(_MENTIONS) + "SELECT t_hour, ticker, cnt FROM c")
def stream_hourly_counts(spark, sf_dir):
    """Hourly counts per symbol: a partial count per hour and micro-batch,
    added up, so late rows and open hours are counted."""
    return jobs.totals(jobs.run_available_now(_mention_stream(spark, sf_dir), "stream-hourly",
                                              per_batch=jobs.hourly_partials))


_TOP_SQL = S.with_(_MENTIONS) + """
SELECT t_hour, ticker, cnt, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY t_hour ORDER BY cnt DESC, ticker ASC) AS rank FROM c)
WHERE rank <= 3"""


@query("stream_top_hourly", _TOP_SQL)
def stream_top_hourly(spark, sf_dir):
    """Top-3 symbols of every hour from the streamed counts."""
    counts = jobs.totals(jobs.run_available_now(_mention_stream(spark, sf_dir), "stream-top",
                                                per_batch=jobs.hourly_partials))
    return ranking.top_k_per(counts, ["t_hour"], [F.desc("cnt"), F.asc("ticker")], 3)


@query("stream_top_kept", _TOP_SQL)
def stream_top_kept(spark, sf_dir):
    """Top-3 symbols of every hour, kept by the stream itself as three rows an hour. The table's files
    are in no order of time, so the delay is the span of their times: no row of it is late."""
    span = table(spark, sf_dir, "events").agg(F.date_diff(F.max("ts"), F.min("ts"))).first()[0]
    return jobs.run_top_per_hour(_mention_stream(spark, sf_dir), "stream-top-kept", 3, f"{(span or 0) + 1} days")


@query("stream_publish", S.with_(_MENTIONS) + "SELECT t_hour, ticker, cnt FROM c")
def stream_publish(spark, sf_dir):
    """A published table of hourly counts by date; a micro-batch replaces only the days it touches."""
    return jobs.run_counts_by_day(_mention_stream(spark, sf_dir), "stream-publish")


@query("stream_event_time_counts", S.with_(_MENTIONS) + "SELECT t_hour, ticker, cnt FROM c")
def stream_event_time_counts(spark, sf_dir):
    """Hourly counts in event time with a watermark; the tables are one delivery, so nothing in them is late."""
    return jobs.run_event_time_counts(_mention_stream(spark, sf_dir), "stream-event-time")[0]


@query("stream_dedup", """
SELECT DISTINCT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS id, CAST(ts AS DATE) AS date FROM events""")
def stream_dedup(spark, sf_dir):
    """One row per post id: every event of a user's day delivers the day's post again."""
    ev = jobs.table_stream(spark, sf_dir, "events")
    posts = ev.select(F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("id"),
                      F.to_date("ts").alias("date"))
    return jobs.run_dedup(posts, "stream-dedup", ["id"], "date")


@query("stream_rule_filter", S.with_(S.PG_UNIVERSE, _LISTING_SQL) + f"""
, d AS (SELECT CAST(doc_id AS VARCHAR) AS id, {S.tagged('text')} AS text FROM documents),
cand AS (SELECT id, unnest(list_distinct({S.cands('text')})) AS symbol FROM d)
SELECT id, symbol FROM cand WHERE symbol IN (SELECT unnest(symbols) FROM rules)""")
def stream_rule_filter(spark, sf_dir):
    """Stream-static semi join: (document, symbol) for symbols of the listing rules."""
    rules = R.build_rules(_listing(spark, sf_dir), k=2)
    posts = dt.document_posts(jobs.table_stream(spark, sf_dir, "documents"))
    hits = jobs.rule_hits(posts, R.rule_symbols(rules))
    return jobs.run_available_now(hits.select("id", "symbol"), "stream-rules")


@query("stream_ingest", S.with_(S.EV_POSTS) + """
SELECT id, author_id, text, CAST(created_at AS DATE) AS date FROM ev_posts""")
def stream_ingest(spark, sf_dir):
    """Envelope files dropped into a folder, read as a stream, flattened and
    written as date-partitioned Parquet with bounded file sizes."""
    drop = scratch_path(spark, "envelope-drop")
    env.envelopes_from_posts(dt.event_posts(table(spark, sf_dir, "events"))) \
        .write.mode("overwrite").json(drop)
    flat = env.flatten_no_context(jobs.envelope_stream(spark, drop))
    out = flat.select("id", "author_id", "text",
                      F.to_date(F.substring("created_at", 1, 10)).alias("date"))
    return jobs.run_available_now(out, "stream-ingest", partition_by=["date"],
                                  max_records_per_file=1000)


@query("stream_compacted", S.with_(S.EV_POSTS) + """
SELECT id, author_id, text, CAST(created_at AS DATE) AS date FROM ev_posts""")
def stream_compacted(spark, sf_dir):
    """Envelope files that arrive one a micro-batch, stored by date and compacted while the stream runs."""
    drop = scratch_path(spark, "envelope-drops")
    posts = dt.event_posts(table(spark, sf_dir, "events"))
    env.envelopes_from_posts(posts.repartition(12, "id")).write.mode("overwrite").json(drop)
    flat = env.flatten_no_context(jobs.envelope_stream(spark, drop, max_files_per_trigger=1))
    out = flat.select("id", "author_id", "text", F.to_date(F.substring("created_at", 1, 10)).alias("date"))
    return jobs.run_compacted(out, "stream-compacted", "date")
