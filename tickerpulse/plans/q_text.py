"""Registered queries on text posts: identification, tags, rules, unions."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..constants import RULE_SIZE_CASHTAG, RULE_SIZE_HASHTAG
from ..functions import entities as E
from ..operators import counts, quality
from ..operators import rules as R
from ..operators.context import conversation_context
from ..operators.facts import union_sources
from ..operators.identify import identify_posts, non_symbol_tag_posts, symbol_table
from ..operators.threads import thread_context, with_threads
from ..session import staged
from ..sources import driver_tables as dt
from ..sources.webpages import page_links, symbol_rows
from . import sql as S
from .inputs import (conversation_fact, conversation_posts, document_fact, document_tags,
                     event_fact, page_universe, table)
from .registry import query

DOC = S.with_(S.PG_UNIVERSE, S.DOC_FACT)


def _conv(strict=False, *extra):
    return S.with_(S.PG_UNIVERSE, S.CONV_POSTS, S.conv_fact(strict), *extra)


@query("identify_tickers", _conv() + "SELECT id, tickers FROM conv_fact", texts=("tickers",))
def identify_tickers(spark, sf_dir):
    """Symbols of each turn from its text and the turn it answers (default mode)."""
    return conversation_fact(spark, sf_dir).select("id", "tickers")


@query("identify_tickers_strict", _conv(True) + "SELECT id, tickers FROM conv_fact", texts=("tickers",))
def identify_tickers_strict(spark, sf_dir):
    """Strict-compat identification: NULL when the context is missing."""
    return conversation_fact(spark, sf_dir, strict_compat=True).select("id", "tickers")


@query("identify_tickers_join", _conv() + "SELECT id, tickers FROM conv_fact", texts=("tickers",))
def identify_tickers_join(spark, sf_dir):
    """Same result from the listing rows themselves, each symbol as often as it is listed."""
    posts = conversation_posts(spark, sf_dir)
    return identify_posts(posts, symbol_rows(table(spark, sf_dir, "pages")), context_col="tweets").select("id", "tickers")


@query("extract_hashtags", DOC + "SELECT id, tags FROM doc_fact", texts=("tags",))
def extract_hashtags(spark, sf_dir):
    return document_tags(spark, sf_dir).select("id", "tags")


@query("extract_cashtags", S.with_() + f"""
SELECT CAST(doc_id AS VARCHAR) AS id,
       {S.cashtags(f"regexp_replace(text, {S.TAGW}, '$\\1', 'g')")} AS tags
FROM documents""", texts=("tags",))
def extract_cashtags(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("string").alias("id"),
                    E.extract_cashtags(dt.cash_tagged_text("text")).alias("tags"))


def _non_symbol_sql():
    tok = r"regexp_extract_all(text, '#([\p{L}\p{N}_]+\|?)', 1)"
    is_sym = f"list_has_any({S.beginnings('t')}, pg_universe.u)"
    clean = S.up(r"regexp_replace(t, '\|$', '')")
    return f"coalesce(list_transform(list_filter({tok}, lambda t: NOT {is_sym}), lambda t: {clean}), [])"


@query("non_ticker_tags", DOC + f"SELECT id, {_non_symbol_sql()} AS tags FROM doc_fact, pg_universe",
       texts=("tags",))
def non_ticker_tags(spark, sf_dir):
    """Hashtags of each document that do not name a listing symbol."""
    posts = dt.document_posts(table(spark, sf_dir, "documents")).select("id", "text")
    return non_symbol_tag_posts(posts, page_universe(spark, sf_dir)).select("id", "tags")


def _rule_sql(rule):
    sym, any_tags, prefix = rule
    parts = []
    if any_tags:
        parts.append("(" + " AND ".join(f"NOT list_contains(tags, '{t}')" for t in any_tags) + ")")
    if prefix is not None:
        parts.append(f"NOT starts_with(text, '{prefix}')")
    return f"(NOT list_contains(tickers, '{sym}') OR " + " AND ".join(parts) + ")"


#: The rules are parameters; these name symbols, tags and beginnings that event posts have.
EVENT_RULES = (("VIEW", ("K1", "K9", "K15"), None), ("CLICK", None, "#K1"), ("ERROR", ("K2", "K36"), None))
_RA, _RB, _RC = EVENT_RULES
_EV = S.with_(S.EV_POSTS)


@query("spam_tag_filter", _EV + f"SELECT id FROM ev_fact WHERE {_rule_sql(_RA)}")
def spam_tag_filter(spark, sf_dir):
    return quality.apply_rules(event_fact(spark, sf_dir), [_RA]).select("id")


@query("spam_text_filter", _EV + f"SELECT id FROM ev_fact WHERE {_rule_sql(_RB)}")
def spam_text_filter(spark, sf_dir):
    return quality.apply_rules(event_fact(spark, sf_dir), [_RB]).select("id")


@query("spam_pair_filter", _EV + f"SELECT id FROM ev_fact WHERE {_rule_sql(_RC)}")
def spam_pair_filter(spark, sf_dir):
    return quality.apply_rules(event_fact(spark, sf_dir), [_RC]).select("id")


@query("spam_rules_all", _EV + "SELECT id FROM ev_fact WHERE "
       + " AND ".join(_rule_sql(r) for r in EVENT_RULES))
def spam_rules_all(spark, sf_dir):
    return quality.apply_rules(event_fact(spark, sf_dir), EVENT_RULES).select("id")


_AUDIT_SQL = _EV + f"""
SELECT count(*) AS rows_in,
       count(*) FILTER (WHERE {_rule_sql(_RA)}) AS after_rule_1,
       count(*) FILTER (WHERE {_rule_sql(_RA)} AND {_rule_sql(_RB)}) AS after_rule_2,
       count(*) FILTER (WHERE {_rule_sql(_RA)} AND {_rule_sql(_RB)} AND {_rule_sql(_RC)}) AS after_rule_3
FROM ev_fact"""


@query("filter_audit", _AUDIT_SQL)
def filter_audit(spark, sf_dir):
    """Rows before and after each spam rule, one pass."""
    return quality.filter_audit(event_fact(spark, sf_dir), EVENT_RULES)


@query("rules_observed", _AUDIT_SQL)
def rules_observed(spark, sf_dir):
    """The same counts out of the job that writes the kept posts, without a scan of their own."""
    audit = Observation()
    staged(quality.apply_rules(event_fact(spark, sf_dir), EVENT_RULES, audit=audit).select("id", "text"), "observed")
    return spark.createDataFrame([audit.get], ", ".join(f"{n} long" for n in ("rows_in", "after_rule_1", "after_rule_2", "after_rule_3")))


@query("posts_about", S.with_(S.EV_POSTS) + "SELECT id, tickers FROM ev_fact WHERE list_contains(tickers, 'VIEW')",
       texts=("tickers",))
def posts_about(spark, sf_dir):
    return quality.posts_about(event_fact(spark, sf_dir), "VIEW").select("id", "tickers")


def _symbol_side(spark, sf_dir):
    """The listing rows as a join side: a semi / anti join needs no distinct,
    and a non-aggregated side lets AQE split a hot tag."""
    return symbol_rows(table(spark, sf_dir, "pages")).withColumnRenamed("symbol", "tag")


@query("universe_semi", DOC + """
SELECT id, tag FROM (SELECT id, unnest(tags) AS tag FROM doc_fact) WHERE tag IN (SELECT symbol FROM pg_symbols)""")
def universe_semi(spark, sf_dir):
    """(document, tag) rows whose tag is a listing symbol: semi join."""
    t = document_tags(spark, sf_dir).select("id", F.explode("tags").alias("tag"))
    return t.join(_symbol_side(spark, sf_dir), "tag", "left_semi")


@query("universe_anti", DOC + """
SELECT id, tag FROM (SELECT id, unnest(tags) AS tag FROM doc_fact) WHERE tag NOT IN (SELECT symbol FROM pg_symbols)""")
def universe_anti(spark, sf_dir):
    t = document_tags(spark, sf_dir).select("id", F.explode("tags").alias("tag"))
    return t.join(_symbol_side(spark, sf_dir), "tag", "left_anti")


@query("tag_freq_universe", DOC + """
SELECT upper(tag) AS tag, count(*) AS cnt FROM (SELECT unnest(tags) AS tag FROM doc_fact WHERE len(tags) > 0)
GROUP BY 1 HAVING upper(tag) IN (SELECT symbol FROM pg_symbols)""")
def tag_freq_universe(spark, sf_dir):
    return counts.tag_freq_universe(document_tags(spark, sf_dir), page_universe(spark, sf_dir))


_EV_ANY = """
ev_any AS (
  SELECT id, author_id, created_at, like_count, quote_count, reply_count, retweet_count, text,
         list_concat(tags, """ + S.cashtags("text") + """) AS tags
  FROM ev_fact
),
ev_tag AS (SELECT *, unnest(tags) AS tag FROM ev_any WHERE len(tags) > 0)"""


def _event_any_tags(spark, sf_dir):
    """Event posts whose ``tags`` hold both the ``#`` and the ``$`` tags of the text."""
    f = event_fact(spark, sf_dir)
    return f.withColumn("tags", F.concat("tags", E.extract_cashtags("text")))


def _event_universe(spark, sf_dir):
    return dt.event_symbols(table(spark, sf_dir, "events"))


@query("dedup_statistics", S.with_(S.EV_POSTS, _EV_ANY) + """
, d AS (SELECT DISTINCT author_id, created_at, like_count, quote_count, reply_count, retweet_count,
                         text, tags, tag FROM ev_tag
        WHERE tag IN (SELECT upper(event_type) FROM events))
SELECT tag, count(*) AS cnt, CAST(sum(retweet_count) AS BIGINT) AS retweets,
       CAST(count(*) + sum(retweet_count) AS BIGINT) AS final_result FROM d GROUP BY tag""")
def dedup_statistics(spark, sf_dir):
    """Per universe tag statistics after dropping duplicate mention rows."""
    return counts.dedup_statistics(_event_any_tags(spark, sf_dir), _event_universe(spark, sf_dir))


@query("cotags_hourly_dedup", S.with_(S.EV_POSTS, _EV_ANY) + """
, c AS (SELECT author_id, created_at, tags, text, tag FROM ev_tag WHERE tag IN (SELECT upper(event_type) FROM events)),
r AS (SELECT DISTINCT * FROM (SELECT *, unnest(tags) AS ref_tag FROM c)
      WHERE ref_tag NOT IN (SELECT upper(event_type) FROM events))
SELECT CAST(date_trunc('hour', created_at) AS TIMESTAMP) AS t_hour, tag, ref_tag, count(*) AS cnt
FROM r GROUP BY 1, 2, 3""")
def cotags_hourly_dedup(spark, sf_dir):
    return counts.cotags_hourly_dedup(_event_any_tags(spark, sf_dir), _event_universe(spark, sf_dir))


@query("conversation_context", S.with_(S.PG_UNIVERSE, S.CONV_POSTS) + f"""
, own AS (SELECT conversation_id, unnest({S.keep(S.cands('text'), 'pg_universe.u')}) AS symbol FROM conv_posts, pg_universe),
per_conv AS (SELECT conversation_id, list_sort(list_distinct(list(symbol))) AS t FROM own GROUP BY 1)
SELECT p.id, CASE WHEN p.conversation_id IS NULL THEN {S.keep(S.cands('p.text'), 'pg_universe.u')} ELSE coalesce(c.t, []) END AS tickers
FROM pg_universe, conv_posts p LEFT JOIN per_conv c USING (conversation_id)""",
       texts=("tickers",))
def conversation_context_q(spark, sf_dir):
    """Symbols of a turn from the whole conversation it belongs to."""
    posts = dt.conversation_turns(table(spark, sf_dir, "conversations"))
    return conversation_context(posts, page_universe(spark, sf_dir)).select("id", "tickers")


def _replies(spark, sf_dir):
    """Turns as posts that name the turn they answer; their conversation id is not used."""
    c = table(spark, sf_dir, "conversations")
    return dt.conversation_turns(c.select("conv_id", "turn", "text")).join(
        c.select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
                 F.concat_ws("-", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string")).alias("replied_to")),
        "id").drop("conversation_id")


_THREADS_SQL = """
turns AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id,
                 CAST(conv_id AS VARCHAR) || '-' || CAST(turn - 1 AS VARCHAR) AS replied_to FROM conversations),
threads AS (SELECT id, id AS root, CAST(0 AS BIGINT) AS depth FROM turns WHERE replied_to NOT IN (SELECT id FROM turns)
            UNION ALL SELECT t.id, p.root, p.depth + 1 FROM turns t JOIN threads p ON t.replied_to = p.id)"""


@query("reply_threads", f"WITH RECURSIVE {_THREADS_SQL} SELECT id, root, depth FROM threads")
def reply_threads(spark, sf_dir):
    """Root and depth of every turn in its chain of answers."""
    return with_threads(_replies(spark, sf_dir)).select("id", "root", "depth")


@query("thread_context", S.with_(S.PG_UNIVERSE, S.CONV_POSTS).replace("WITH", "WITH RECURSIVE", 1) + f"""
, {_THREADS_SQL},
own AS (SELECT h.root, unnest({S.keep(S.cands('p.text'), 'pg_universe.u')}) AS symbol FROM pg_universe, conv_posts p JOIN threads h USING (id)),
per_root AS (SELECT root, list_sort(list_distinct(list(symbol))) AS t FROM own GROUP BY 1)
SELECT h.id, coalesce(r.t, []) AS tickers FROM threads h LEFT JOIN per_root r USING (root)""", texts=("tickers",))
def thread_context_q(spark, sf_dir):
    """Symbols of the whole thread of a turn, found through the answers alone."""
    return thread_context(_replies(spark, sf_dir), page_universe(spark, sf_dir)).select("id", "tickers")


_UNION_SQL = S.with_(S.PG_UNIVERSE, S.DOC_FACT, S.CONV_POSTS, S.conv_fact()) + """
, u AS (SELECT source, tickers, tags FROM doc_fact UNION ALL SELECT source, tickers, tags FROM conv_fact)"""


@query("union_sources", _UNION_SQL + """
SELECT CASE WHEN source = 'conversations' THEN 'conversations' ELSE 'documents' END AS origin,
       count(*) AS posts, CAST(sum(len(tickers)) AS BIGINT) AS mentions, CAST(sum(len(tags)) AS BIGINT) AS tags
FROM u GROUP BY 1""")
def union_sources_q(spark, sf_dir):
    """Bag union of two post sources by name (one side has extra columns)."""
    u = union_sources(document_fact(spark, sf_dir), conversation_fact(spark, sf_dir))
    origin = F.when(F.col("source") == "conversations", "conversations").otherwise("documents")
    return u.groupBy(origin.alias("origin")).agg(
        F.count(F.lit(1)).alias("posts"), F.sum(F.size("tickers")).cast("bigint").alias("mentions"),
        F.sum(F.size("tags")).cast("bigint").alias("tags"))


@query("freq_by_source", _UNION_SQL + f"""
, m AS (SELECT source, {S.unnest_outer('tickers')} AS ticker FROM u)
SELECT source, ticker, count(*) AS cnt FROM m GROUP BY source, ticker""")
def freq_by_source(spark, sf_dir):
    """Both sources side by side: ticker frequency per source in one aggregate."""
    u = union_sources(document_fact(spark, sf_dir), conversation_fact(spark, sf_dir))
    return u.select("source", F.explode_outer("tickers").alias("ticker")) \
        .groupBy("source", "ticker").agg(F.count(F.lit(1)).alias("cnt"))


_LISTING_SQL = """
listing AS (SELECT page_id, CAST((pos - 1) / 2 AS BIGINT) AS rank, """ + S.up("link") + """ AS symbol FROM pg_links
            WHERE trim(link) <> ''),
rules AS (
  SELECT page_id, CAST(floor(rank / 2) AS BIGINT) AS rule_no,
         list(symbol ORDER BY rank) AS symbols,
         array_to_string(list('$' || symbol ORDER BY rank), ' OR ') AS value
  FROM listing GROUP BY 1, 2
)"""


_GLOBAL_LISTING_SQL = """
first AS (SELECT symbol, page_id, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY page_id, rank) AS rn FROM listing) WHERE rn = 1),
glisting AS (SELECT CAST(0 AS BIGINT) AS page_id,
                    CAST(row_number() OVER (ORDER BY page_id, rank, symbol) - 1 AS BIGINT) AS rank, symbol FROM first),
grules AS (SELECT page_id, CAST(floor(rank / 6) AS BIGINT) AS rule_no, symbol FROM glisting)"""


def _listing(spark, sf_dir):
    links = page_links(table(spark, sf_dir, "pages"))
    return links.where(F.trim("link") != "").select(
        "page_id", ((F.col("pos") - 1) / 2).cast("bigint").alias("rank"),
        F.upper("link").alias("symbol"))


@query("build_rules", S.with_(S.PG_UNIVERSE, _LISTING_SQL) + "SELECT page_id, rule_no, symbols, value FROM rules",
       texts=("symbols",))
def build_rules(spark, sf_dir):
    """Symbols of each listing page in order, 2 per ``$``-prefixed OR rule (pages have up to three)."""
    return R.build_rules(_listing(spark, sf_dir), k=2, prefix="$")


@query("build_rules_global", S.with_(S.PG_UNIVERSE, _LISTING_SQL, _GLOBAL_LISTING_SQL) + """
SELECT 6 AS k, CAST(floor(rank / 6) AS BIGINT) AS rule_no, array_to_string(list('$' || symbol ORDER BY rank), ' OR ') AS value
FROM glisting GROUP BY 2
UNION ALL SELECT 17, CAST(floor(rank / 17) AS BIGINT), array_to_string(list('#' || symbol ORDER BY rank), ' OR ')
FROM glisting GROUP BY 2""")
def build_rules_global(spark, sf_dir):
    """The rules of both collectors over the whole listing: 6 cashtags and 17 hashtags a rule."""
    listing = staged(R.global_listing(_listing(spark, sf_dir)), "listing")
    parts = [R.build_rules(listing, k, prefix).select(F.lit(k).alias("k"), "rule_no", "value")
             for k, prefix in ((RULE_SIZE_CASHTAG, "$"), (RULE_SIZE_HASHTAG, "#"))]
    return parts[0].unionByName(parts[1])


@query("rule_match", S.with_(S.PG_UNIVERSE, _LISTING_SQL, _GLOBAL_LISTING_SQL, S.CONV_POSTS) + f"""
, cand AS (SELECT DISTINCT id, unnest(list_distinct({S.cands('text')})) AS symbol FROM conv_posts)
SELECT DISTINCT id, page_id, rule_no FROM cand JOIN grules USING (symbol)""")
def rule_match(spark, sf_dir):
    """(post, rule) pairs over one listing of all listed symbols (each symbol
    in one rule of 6), so a post emits at most one row per matched symbol."""
    rules = R.build_rules(R.global_listing(_listing(spark, sf_dir)), k=6)
    return R.rule_match(conversation_posts(spark, sf_dir), rules)


@query("rule_semi", S.with_(S.PG_UNIVERSE, _LISTING_SQL, S.CONV_POSTS) + f"""
, rs AS (SELECT list(DISTINCT symbol) AS l FROM (SELECT unnest(symbols) AS symbol FROM rules))
SELECT id FROM conv_posts, rs WHERE list_has_any({S.cands('text')}, rs.l)""")
def rule_semi(spark, sf_dir):
    rules = R.build_rules(_listing(spark, sf_dir), k=2)
    return R.rule_semi(conversation_posts(spark, sf_dir), rules).select("id")


@query("sql_identify", DOC + "SELECT id, tickers, tags FROM doc_fact", texts=("tickers", "tags"))
def sql_identify(spark, sf_dir):
    """Identification and tags written in Spark SQL: the library's SQL functions
    over a view of the posts, and a semi join with a view of the listing symbols."""
    from ..functions.sql_functions import register_sql_functions
    symbols = symbol_table(symbol_rows(table(spark, sf_dir, "pages")))
    register_sql_functions(spark, prefix="tpl_", lengths=E.symbol_lengths(symbols))
    dt.document_posts(table(spark, sf_dir, "documents")).createOrReplaceTempView("tpl_documents")
    symbols.createOrReplaceTempView("tpl_symbols")
    # an expression is exploded: of a plain column Spark would ask its size first, and find the candidates twice
    staged(spark.sql("""
        WITH c AS (SELECT sha2(text, 256) AS k, tpl_candidates(text) AS cands FROM tpl_documents),
        s AS (SELECT k, explode(reverse(cands)) AS symbol FROM c)
        SELECT k, array_sort(collect_set(symbol)) AS tickers FROM s LEFT SEMI JOIN tpl_symbols USING (symbol) GROUP BY k"""),
        "found").createOrReplaceTempView("tpl_found")
    return spark.sql("""
        WITH c AS (SELECT id, coalesce(sha2(text, 256), concat('-', id), '-') AS k, tpl_hashtags(text) AS tags FROM tpl_documents)
        SELECT id, coalesce(tickers, CAST(array() AS ARRAY<STRING>)) AS tickers, tags FROM c LEFT JOIN tpl_found USING (k)""")
