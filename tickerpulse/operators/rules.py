"""Match rules: symbols in listing order grouped k per OR rule, and which
posts each rule catches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.entities import symbol_candidates, symbol_lengths
from ..session import staged
from .identify import found_symbols, text_key
from .numbering import numbered


def build_rules(listing: DataFrame, k: int, prefix: str = "$",
                group_col: str = "page_id", order_col: str = "rank") -> DataFrame:
    """Rules of ``k`` symbols from an ordered listing (one listing per ``group_col``).

    ``order_col`` is the 0-based position of the symbol in its listing, so
    ``rule_no = order // k`` needs no global window; each rule's symbols
    are collected (at most ``k`` per key) and sorted by position.
    Output: group, rule_no, symbols (array), value (``"$A OR $B ..."``).
    """
    r = listing.select(group_col, F.floor(F.col(order_col) / k).cast("bigint").alias("rule_no"),
                       F.struct(order_col, "symbol").alias("s"))
    g = r.groupBy(group_col, "rule_no").agg(F.array_sort(F.collect_list("s")).alias("ss"))
    syms = F.transform("ss", lambda x: x["symbol"])
    return g.select(group_col, "rule_no", syms.alias("symbols"),
                    F.array_join(F.transform(syms, lambda s: F.concat(F.lit(prefix), s)), " OR ")
                    .alias("value"))


def global_listing(listing: DataFrame, group_col: str = "page_id", order_col: str = "rank") -> DataFrame:
    """One listing from many: each distinct symbol once, ordered by its first
    appearance (listing id, position), with a 0-based ``rank``.

    With one listing every symbol lands in exactly one rule, so matching
    posts to rules emits at most one row per matched symbol.
    """
    first = listing.groupBy("symbol").agg(F.min(F.struct(group_col, order_col)).alias("f")) \
        .select("symbol", F.col("f")[group_col].alias("_g"), F.col("f")[order_col].alias("_o"))
    return numbered(first, F.col("_g"), F.col("_o"), F.col("symbol"), name=order_col) \
        .select(F.lit(0).cast("bigint").alias(group_col), order_col, "symbol")


def rule_symbols(rules: DataFrame, group_col: str = "page_id") -> DataFrame:
    return rules.select(group_col, "rule_no", F.explode("symbols").alias("symbol"))


def rule_match(posts: DataFrame, rules: DataFrame, group_col: str = "page_id",
               id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(post, rule) pairs where the post's text names one of the rule's symbols
    with a symbol prefix. Equi-join on the symbol; the rule side is left to
    AQE's runtime size check for broadcasting."""
    syms = rule_symbols(rules, group_col)
    cand = posts.select(id_col, F.explode(symbol_candidates(text_col, symbol_lengths(syms.select("symbol")))).alias("symbol"))
    return cand.join(syms, "symbol").select(id_col, group_col, "rule_no").distinct()


def rule_semi(posts: DataFrame, rules: DataFrame, group_col: str = "page_id",
              text_col: str = "text") -> DataFrame:
    """Posts caught by at least one rule (the stream filter's result).

    Posts meet the texts that hit by digest, so ids play no part: repeated and
    NULL ones are judged by their own text.
    """
    symbols = staged(rule_symbols(rules, group_col).select("symbol").distinct(), "rule-symbols")
    whole = F.coalesce(F.col(text_col), F.lit(""))
    hits = staged(found_symbols(posts, whole, symbols).select("_k").distinct(), "rule-hits")
    return posts.withColumn("_k", text_key(whole, posts)).join(hits, "_k", "left_semi").select(*posts.columns)
