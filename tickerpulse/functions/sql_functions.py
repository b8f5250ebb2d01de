"""The core expressions as temporary SQL functions, for ``spark.sql`` users.

``register_sql_functions(spark)`` creates SQL functions whose bodies are
plain SQL expressions; Spark inlines them into the query, so a view like

    SELECT tp_identify(text) AS tickers, tp_hashtags(text) AS tags FROM posts

plans exactly like the DataFrame functions (no Python in the plan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..constants import SPAM_RULES, TICKERS
from .entities import CASHTAG, HASHTAG, SYMBOL_RUN, bounded_candidate_pattern


def _lit(s: str) -> str:
    """A Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _extract_upper(text: str, pattern: str) -> str:
    return f"transform(regexp_extract_all({text}, {_lit(pattern)}, 1), x -> upper(x))"


def _candidates(text: str, lengths: Sequence[int] | None = None) -> str:
    """Same as ``entities.symbol_candidates`` ([] for NULL), sorted."""
    tried, alone = "sequence(1, length(r))", "array(r)"
    if lengths is not None:
        tried = f"CAST(array({', '.join(map(str, lengths))}) AS ARRAY<INT>)"
        alone = f"filter(array(r), x -> array_contains({tried}, length(x)))"
    ends = f"filter({tried}, i -> i = length(r) OR (i < length(r) AND NOT substring(r, i + 1, 1) RLIKE '[A-Za-z|]'))"
    each = f"CASE WHEN r RLIKE '^[A-Za-z]+$' THEN {alone} ELSE transform({ends}, i -> substring(r, 1, i)) END"
    runs = f"array_distinct(regexp_extract_all({text}, {_lit(SYMBOL_RUN)}, 1))"
    return (f"coalesce(array_sort(array_distinct(transform(flatten(transform({runs}, r -> {each})), x -> upper(x)))), "
            "CAST(array() AS ARRAY<STRING>))")


def _keep(cands: str, universe: Sequence[str]) -> str:
    inlist = ", ".join(_lit(s) for s in universe)
    return f"array_sort(array_distinct(filter({cands}, c -> c IN ({inlist}))))"


def _rule_sql(rule) -> str:
    symbol, any_tags, prefix = rule
    parts = []
    if any_tags:
        parts.append("(" + " AND ".join(f"NOT array_contains(tags, {_lit(t)})" for t in any_tags) + ")")
    if prefix is not None:
        parts.append(f"NOT startswith(text, {_lit(prefix)})")
    return f"(NOT array_contains(tickers, {_lit(symbol)}) OR " + " AND ".join(parts) + ")"


def sql_function_bodies(universe: Sequence[str] = TICKERS, rules=SPAM_RULES,
                        lengths: Sequence[int] | None = None) -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, return type, SQL body). ``lengths`` (``entities.symbol_lengths`` of
    the symbols to be joined) bounds ``candidates``, which are else quadratic in a run."""
    u = list(dict.fromkeys(s.upper() for s in universe))
    if not all(s.isascii() and s.isalpha() for s in u):
        raise ValueError("the literal SQL functions take symbols of ASCII letters; join on candidates(text) for others")
    pat = bounded_candidate_pattern(max((len(s) for s in u), default=1))
    empty = "CAST(array() AS ARRAY<STRING>)"
    own = f"coalesce({_extract_upper('text', pat)}, {empty})"
    ctx = (f"coalesce(flatten(transform(ctx, r -> coalesce({_extract_upper('r.text', pat)}, {empty}))), "
           f"{empty})")
    return {
        "hashtags": ("text STRING", "ARRAY<STRING>", f"coalesce({_extract_upper('text', HASHTAG)}, {empty})"),
        "cashtags": ("text STRING", "ARRAY<STRING>", f"coalesce({_extract_upper('text', CASHTAG)}, {empty})"),
        "candidates": ("text STRING", "ARRAY<STRING>", _candidates("text", lengths)),
        "identify": ("text STRING", "ARRAY<STRING>", _keep(own, u)),
        "identify_ctx": ("text STRING, ctx ARRAY<STRUCT<id: STRING, text: STRING>>", "ARRAY<STRING>",
                         _keep(f"concat({own}, {ctx})", u)),
        "spam_keep": ("tickers ARRAY<STRING>, tags ARRAY<STRING>, text STRING", "BOOLEAN",
                      " AND ".join(_rule_sql(r) for r in rules)),
    }


def register_sql_functions(spark: SparkSession, universe: Sequence[str] = TICKERS,
                           prefix: str = "tp_", rules=SPAM_RULES,
                           lengths: Sequence[int] | None = None) -> list[str]:
    names = []
    for name, (params, rtype, body) in sql_function_bodies(universe, rules, lengths).items():
        full = prefix + name
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {full}({params}) RETURNS {rtype} RETURN {body}")
        names.append(full)
    return names
