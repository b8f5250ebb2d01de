"""Shared inputs of the registered queries: identified post facts built
from the driver tables through the library's own operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.facts import post_fact
from ..operators.identify import identify_and_tag, with_tags
from ..sources import driver_tables as dt
from ..sources.webpages import symbol_universe


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return dt.load(spark, sf_dir, name)


def event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (user, day) posts -> identify against the event-type symbols -> fact."""
    ev = table(spark, sf_dir, "events")
    posts = dt.event_posts(ev)
    return post_fact(identify_and_tag(posts, dt.event_symbols(ev)))


def page_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return symbol_universe(table(spark, sf_dir, "pages"))


def document_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> tagged posts -> identify against the listing symbols -> fact."""
    posts = dt.document_posts(table(spark, sf_dir, "documents"))
    return post_fact(identify_and_tag(posts, page_universe(spark, sf_dir)))


def document_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> tagged posts with ``tags`` only (no symbol universe needed)."""
    return with_tags(dt.document_posts(table(spark, sf_dir, "documents")))


def conversation_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dt.conversation_posts(table(spark, sf_dir, "conversations"))


def conversation_fact(spark: SparkSession, sf_dir: str, strict_compat: bool = False) -> DataFrame:
    """conversation turns with their answered turn as context -> fact."""
    posts = conversation_posts(spark, sf_dir)
    ident = identify_and_tag(posts, page_universe(spark, sf_dir), context_col="tweets",
                             strict_compat=strict_compat)
    return post_fact(ident)
