"""Posts -> posts with ``tickers`` and ``tags``.

Two physical forms of the same result, chosen by what the caller passes:

* a Python list: the universe is a literal set inside one Column expression
  (map-only, no shuffle);
* a DataFrame: the symbols are stored as a table. While they are few
  (``SET_SYMBOLS``, ``SET_CHARS``) they become a literal set as well, so posts are
  read once and never shuffled. More of them are joined: the candidates of each
  text meet the table in a semi join, and what was found goes back to the posts
  by a digest of the text. Candidates that name no symbol end at that join,
  texts and candidates are never grouped or joined on. Repeated and NULL post
  ids do not matter, and both give the same rows. Joins are not hinted;
  Spark's own size checks decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.entities import (SYMBOL_SIGN, beginnings, extract_hashtags, identify_tickers, symbol_candidates,
                                  symbol_lengths, tag_of, tag_tokens)
from ..session import staged

EMPTY = "array<string>"
#: Symbols of a table, and characters of them all, up to which they are one literal set.
SET_SYMBOLS, SET_CHARS = 5000, 100_000


def symbol_table(universe: DataFrame) -> DataFrame:
    """The different upper-cased symbols as a stored table: its size is known when a
    join is planned, so texts are not shuffled to meet a small one."""
    return staged(universe.select(F.upper(F.col(universe.columns[0])).alias("symbol")).distinct(), "symbols")


def symbol_set(symbols: DataFrame) -> list[str] | None:
    """The stored ``symbols`` if they are few; None if they are to be joined."""
    n, chars = symbols.agg(F.count("symbol"), F.sum(F.length("symbol"))).first()
    if n > SET_SYMBOLS or (chars or 0) > SET_CHARS:
        return None
    return [r[0] for r in symbols.where(F.col("symbol").isNotNull()).collect()]


def text_key(whole: Column, posts: DataFrame) -> Column:
    """A key of the text ``whole`` of ``posts``; texts without a prefix sign, which
    name nothing, are spread over many keys. Never NULL."""
    spread = F.pmod(F.xxhash64(*[c for c, t in posts.dtypes if "map<" not in t and "variant" not in t]), F.lit(997))
    return F.coalesce(F.when(whole.rlike(SYMBOL_SIGN), F.unhex(F.sha2(whole, 256))).otherwise(F.concat(F.lit("-"), spread.cast("string")).cast("binary")),
                      F.lit(b""))


def found_symbols(posts: DataFrame, whole: Column, symbols: DataFrame) -> DataFrame:
    """(_k, symbol): which of the stored ``symbols`` the texts name, by ``text_key``; rows may repeat."""
    # the key is made below the explode, once a text instead of once a candidate
    texts = posts.select(text_key(whole, posts).alias("_k"), whole.alias("_text"))
    return texts.select("_k", F.explode(symbol_candidates("_text", symbol_lengths(symbols))).alias("symbol")) \
        .join(symbols, "symbol", "left_semi")


def identify_posts(posts: DataFrame, universe, text_col: str = "text",
                   context_col: str | None = None, strict_compat: bool = False) -> DataFrame:
    """Add ``tickers`` (sorted distinct universe symbols of text + context).

    ``universe`` is a list of symbols or a DataFrame with one column of them.
    """
    ctx = F.col(context_col) if context_col else None
    if not isinstance(universe, DataFrame):
        return posts.withColumn("tickers", identify_tickers(
            F.col(text_col), ctx, [s.upper() for s in universe], strict_compat=strict_compat))
    text = F.col(text_col)
    # a match never spans the blank between a text and its context
    whole = F.concat_ws(" ", text, F.transform(ctx, lambda r: r["text"])) if context_col else F.coalesce(text, F.lit(""))
    null_in = text.isNull() | ctx.isNull() if context_col else text.isNull()
    symbols = symbol_table(universe)
    few = symbol_set(symbols)
    if few is not None:
        tk = F.array_sort(F.filter(symbol_candidates(whole, symbol_lengths(symbols)), lambda c: c.isin(few)))
        return posts.withColumn("tickers", F.when(~null_in, tk) if strict_compat else tk)
    found = staged(found_symbols(posts, whole, symbols)
                   .groupBy("_k").agg(F.array_sort(F.collect_set("symbol")).alias("_t")), "found")
    keyed = posts.withColumns({"_k": text_key(whole, posts), "_null": null_in})
    tk = F.coalesce(F.col("_t"), F.array().cast(EMPTY))
    if strict_compat:
        tk = F.when(F.col("_null"), F.lit(None).cast(EMPTY)).otherwise(tk)
    return keyed.join(found, "_k", "left").withColumn("tickers", tk).select(*posts.columns, "tickers")


def non_symbol_tag_posts(posts: DataFrame, universe: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``tags``: hashtags that name no symbol of the one-column ``universe``,
    upper-cased, in text order (``entities.non_symbol_tags`` with a table)."""
    symbols = symbol_table(universe)
    lengths = symbol_lengths(symbols)
    few = symbol_set(symbols)
    if few is not None:
        kept = F.filter(tag_tokens(text_col), lambda w: ~F.exists(beginnings(w, lengths), lambda b: F.upper(b).isin(few)))
        return posts.withColumn("tags", F.transform(kept, tag_of))
    empty = F.array().cast(EMPTY)
    key = text_key(F.coalesce(F.col(text_col), F.lit("")), posts)
    pairs = F.flatten(F.transform(F.array_distinct(tag_tokens("_text")), lambda w: F.transform(
        beginnings(w, lengths), lambda b: F.struct(w.alias("token"), F.upper(b).alias("symbol")))))
    naming = posts.select(key.alias("_k"), F.col(text_col).alias("_text")).select("_k", F.explode(pairs).alias("_p")).select("_k", "_p.*").join(symbols, "symbol", "left_semi")
    found = staged(naming.groupBy("_k").agg(F.collect_set("token").alias("_t")), "naming")
    keyed = posts.withColumns({"_w": tag_tokens(text_col), "_k": key})
    kept = F.filter("_w", lambda w: ~F.array_contains(F.coalesce(F.col("_t"), empty), w))
    return keyed.join(found, "_k", "left").withColumn("tags", F.transform(kept, tag_of)).select(*posts.columns, "tags")


def with_tags(posts: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``tags``: upper hashtags of the post's own text, in order, duplicates kept."""
    return posts.withColumn("tags", extract_hashtags(text_col))


def identify_and_tag(posts: DataFrame, universe, context_col: str | None = None,
                     strict_compat: bool = False) -> DataFrame:
    # tags come first, so that a text which nobody asks for stays out of the shuffle
    found = identify_posts(with_tags(posts), universe, context_col=context_col, strict_compat=strict_compat)
    return found.select(*posts.columns, "tickers", *(["tags"] if "tags" not in posts.columns else []))
