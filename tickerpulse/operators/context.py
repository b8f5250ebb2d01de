"""Conversation context when posts are rows of a table (not nested).

A post's context is the other posts of its conversation; since matching
text + context equals the union of the per-post matches, the symbols of a
post are the symbols of its whole conversation. They are found per post,
reduced to one distinct symbol set per conversation with partial
aggregation (bounded by the universe size), staged, and joined back on the
conversation id. Staging gives the join two plain sides, so adaptive
execution splits a conversation that holds a large share of all posts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.entities import identify_tickers, symbol_candidates, symbol_lengths
from ..session import staged
from .identify import identify_posts


def conversation_context(posts: DataFrame, universe, conv_col: str = "conversation_id",
                         text_col: str = "text") -> DataFrame:
    """Add ``tickers``: sorted distinct symbols of the post's conversation.

    A post without a conversation id is a conversation of its own. ``universe`` is a list of symbols or a DataFrame with one column of them.
    """
    alone = identify_posts(posts.where(F.col(conv_col).isNull()), universe, text_col)
    posts = posts.where(F.col(conv_col).isNotNull())
    if isinstance(universe, DataFrame):
        symbols = universe.select(F.upper(F.col(universe.columns[0])).alias("symbol"))
        own = posts.select(conv_col, F.explode(symbol_candidates(text_col, symbol_lengths(symbols))).alias("symbol")) \
            .distinct().join(symbols, "symbol", "left_semi")
    else:
        own = posts.select(conv_col, F.explode(identify_tickers(F.col(text_col), None, universe)).alias("symbol"))
    # collect_set is combined map-side; its state is bounded by the universe size.
    per_conv = staged(own.groupBy(conv_col).agg(F.array_sort(F.collect_set("symbol")).alias("conv_tickers")), "per-conversation")
    out = posts.join(per_conv, conv_col, "left").withColumn("tickers", F.coalesce("conv_tickers", F.array().cast("array<string>")))
    return out.select(*posts.columns, "tickers").unionByName(alone)
