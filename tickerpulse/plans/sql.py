"""DuckDB oracle fragments: the same stand-in inputs and identification
rules written as plain SQL, to check the Spark plans independently.

DuckDB upper-cases ``ß`` to ``ẞ`` where Spark (like Python) gives ``SS``;
the oracle maps it back so both sides follow the Python rule.
"""

from __future__ import annotations

RUN = r"'[$#＃]([^\s$#＃]+)'"
HASH = r"'#([\p{L}\p{N}_]+)'"
CASH = r"'\$([\p{L}\p{N}_]+)'"
TAGW = r"'(\p{L}{6,})'"
LINK = """'<a href="/[^"]*">([^<]*)</a>'"""


def up(x: str) -> str:
    return f"replace(upper({x}), 'ẞ', 'SS')"


def beginnings(r: str) -> str:
    return (f"list_transform(list_filter(range(1, CAST(length({r}) AS BIGINT) + 1), lambda i: i = length({r}) "
            f"OR NOT regexp_matches(substring({r}, i + 1, 1), '[A-Za-z|]')), lambda i: {up(f'substring({r}, 1, i)')})")


def cands(text: str) -> str:
    return f"coalesce(flatten(list_transform(regexp_extract_all({text}, {RUN}, 1), lambda x: {beginnings('x')})), [])"


def tags(text: str) -> str:
    return f"coalesce(list_transform(regexp_extract_all({text}, {HASH}, 1), lambda x: {up('x')}), [])"


def cashtags(text: str) -> str:
    return f"coalesce(list_transform(regexp_extract_all({text}, {CASH}, 1), lambda x: {up('x')}), [])"


def keep(c: str, u: str) -> str:
    return f"list_sort(list_distinct(list_filter({c}, lambda x: list_contains({u}, x))))"


def unnest_outer(x: str) -> str:
    """DuckDB form of ``explode_outer``: one NULL row for a NULL or empty list."""
    return f"unnest(CASE WHEN {x} IS NULL OR len({x}) = 0 THEN [NULL] ELSE {x} END)"


def tagged(text: str) -> str:
    return f"regexp_replace({text}, {TAGW}, '#\\1', 'g')"


EV_POSTS = f"""
ev_posts AS (
  SELECT CAST(user_id AS VARCHAR) || '-' || strftime(d, '%Y%m%d') AS id,
         'cashtag' AS source,
         CAST(user_id AS VARCHAR) AS author_id,
         min(ts) AS created_at,
         CAST(sum(floor(value)) AS BIGINT) AS like_count,
         CAST(min(floor(value)) AS BIGINT) AS quote_count,
         CAST(max(floor(value)) AS BIGINT) AS reply_count,
         count(*) AS retweet_count,
         array_to_string(list_sort(list_distinct(list_concat(
             list('$' || upper(event_type)),
             list('#K' || json_extract_string(props, '$.k'))))), ' ') AS text
  FROM (SELECT *, CAST(ts AS DATE) AS d FROM events)
  GROUP BY user_id, d
),
ev_universe AS (SELECT list(DISTINCT upper(event_type)) AS u FROM events),
ev_fact AS (
  SELECT id, source, author_id, created_at, CAST(created_at AS DATE) AS date,
         CAST(month(created_at) AS INTEGER) AS month, CAST(day(created_at) AS INTEGER) AS day,
         CAST(hour(created_at) AS INTEGER) AS hour,
         like_count, quote_count, reply_count, retweet_count, text,
         {keep(cands('text'), 'ev_universe.u')} AS tickers,
         {tags('text')} AS tags
  FROM ev_posts, ev_universe
)"""

# every second listing link (0-based odd positions) of each page
PG_LINKS = f"""
pg_links AS (
  SELECT page_id, CAST(idx - 1 AS BIGINT) AS pos, link FROM (
    SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) AS idx
    FROM (SELECT page_id, regexp_extract_all(html, {LINK}, 1) AS l FROM pages))
  WHERE (idx - 1) % 2 = 1
)"""

PG_UNIVERSE = PG_LINKS + """,
pg_symbols AS (SELECT DISTINCT """ + up("link") + """ AS symbol FROM pg_links WHERE trim(link) <> ''),
pg_universe AS (SELECT list(symbol) AS u FROM pg_symbols)"""

DOC_FACT = f"""
doc_posts AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, source, lang AS author_id,
         CAST(NULL AS TIMESTAMP) AS created_at, CAST(0 AS BIGINT) AS like_count,
         CAST(0 AS BIGINT) AS quote_count, CAST(0 AS BIGINT) AS reply_count,
         CAST(n_chars AS BIGINT) AS retweet_count, {tagged('text')} AS text
  FROM documents
),
doc_fact AS (
  SELECT id, source, author_id, created_at, CAST(NULL AS DATE) AS date,
         CAST(NULL AS INTEGER) AS month, CAST(NULL AS INTEGER) AS day, CAST(NULL AS INTEGER) AS hour,
         like_count, quote_count, reply_count, retweet_count, text,
         {keep(cands('text'), 'pg_universe.u')} AS tickers,
         {tags('text')} AS tags
  FROM doc_posts, pg_universe
)"""

CONV_POSTS = f"""
conv_base AS (SELECT conv_id, turn, role, {tagged('text')} AS text FROM conversations),
conv_posts AS (
  SELECT CAST(c.conv_id AS VARCHAR) || '-' || CAST(c.turn AS VARCHAR) AS id,
         'conversations' AS source, c.role AS author_id,
         CAST(c.conv_id AS VARCHAR) AS conversation_id, c.turn,
         CAST(NULL AS TIMESTAMP) AS created_at, CAST(0 AS BIGINT) AS like_count,
         CAST(0 AS BIGINT) AS quote_count, CAST(0 AS BIGINT) AS reply_count,
         CAST(c.turn AS BIGINT) AS retweet_count, c.text,
         CASE WHEN p.conv_id IS NOT NULL THEN
           [{{'id': CAST(p.conv_id AS VARCHAR) || '-' || CAST(p.turn AS VARCHAR), 'text': p.text}}]
         END AS tweets
  FROM conv_base c LEFT JOIN conv_base p ON p.conv_id = c.conv_id AND p.turn + 1 = c.turn
)"""


def conv_fact(strict: bool = False) -> str:
    ctx = "coalesce(flatten(list_transform(tweets, lambda r: " + cands("r.text") + ")), [])"
    tk = keep(f"list_concat({cands('text')}, {ctx})", "pg_universe.u")
    if strict:
        tk = f"CASE WHEN text IS NULL OR tweets IS NULL THEN NULL ELSE {tk} END"
    return f"""
conv_fact AS (
  SELECT id, source, author_id, created_at, CAST(NULL AS DATE) AS date,
         CAST(NULL AS INTEGER) AS month, CAST(NULL AS INTEGER) AS day, CAST(NULL AS INTEGER) AS hour,
         like_count, quote_count, reply_count, retweet_count, text,
         {tk} AS tickers, {tags('text')} AS tags, conversation_id, turn, tweets
  FROM conv_posts, pg_universe
)"""


def with_(*parts: str) -> str:
    if not parts:
        return ""
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"
