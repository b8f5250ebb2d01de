"""Batch job: envelope files of the two collectors -> published tables.

    python -m tickerpulse.publish_job --hashtag 'h/*.json' --cashtag 'c/*.json' --out /shared/tables

Steps: read each collector's envelope files with the explicit schema,
re-close unclosed documents, flatten with the conversation context,
identify symbols and tags, drop known spam from the hashtag collector,
union both sources, derive the post fact and publish the table set from
one staged copy of it.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .constants import TICKERS
from .operators.facts import post_fact, tweets_to_posts, union_sources
from .operators.identify import identify_and_tag
from .operators.quality import apply_rules
from .sinks.tables import publish_all
from .sinks.versions import publish_version
from .sources.envelopes import corrupt_files, read_envelopes, repair_unclosed


def identified(env: DataFrame, universe, strict_compat: bool = False, audit: Observation | None = None) -> DataFrame:
    """Repaired envelopes (tweets, source) -> post fact: flattened with the conversation
    context, identified and tagged, known spam dropped from the hashtag collector; ``audit``
    receives how many of that collector's posts each rule left."""
    tweets = env.select("source", F.explode("tweets").alias("col"))
    if not strict_compat:
        tweets = tweets.where(F.col("col.data.id").isNotNull())
    posts = tweets_to_posts(tweets.select("col.data.*", "col.includes.tweets", "source"), F.col("source"))
    found = identify_and_tag(posts, universe, context_col="tweets", strict_compat=strict_compat)
    return post_fact(apply_rules(found, only_source="hashtag", audit=audit))


def envelopes(spark: SparkSession, hashtag_path: str | None, cashtag_path: str | None, multi_line: bool = True) -> DataFrame:
    """The documents of both collectors (a bag union) with their ``source``, unclosed ones closed."""
    parts = [read_envelopes(spark, path, multi_line=multi_line).withColumn("source", F.lit(source))
             for source, path in (("hashtag", hashtag_path), ("cashtag", cashtag_path)) if path]
    if not parts:
        raise ValueError("no input given")
    return repair_unclosed(union_sources(*parts))


def build_fact(spark: SparkSession, hashtag_path: str | None, cashtag_path: str | None,
               universe=TICKERS, multi_line: bool = True, strict_compat: bool = False) -> DataFrame:
    return identified(envelopes(spark, hashtag_path, cashtag_path, multi_line), universe, strict_compat)


def run(spark: SparkSession, hashtag_path: str | None, cashtag_path: str | None, out: str,
        universe=TICKERS, multi_line: bool = True, strict_compat: bool = False,
        k: int = 5, audit: Observation | None = None) -> dict[str, str]:
    """Publish the table set; documents that stay unreadable go to ``quarantine`` as JSON lines."""
    env = envelopes(spark, hashtag_path, cashtag_path, multi_line)
    quarantine = os.path.join(out, "quarantine")
    corrupt_files(env).write.mode("overwrite").json(quarantine)
    return publish_all(identified(env, universe, strict_compat, audit), out, k=k) | {"quarantine": quarantine}


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--hashtag", help="glob of the hashtag collector's envelope files")
    ap.add_argument("--cashtag", help="glob of the cashtag collector's envelope files")
    ap.add_argument("--out", required=True, help="folder for the published tables")
    ap.add_argument("--lines", action="store_true", help="one envelope per line instead of one per file")
    ap.add_argument("--strict", action="store_true", help="NULL symbols for posts without context")
    ap.add_argument("--k", type=int, default=5)
    ap.add_argument("--versions", action="store_true", help="publish as a new version that readers see at once (sinks.versions)")
    a = ap.parse_args(argv)
    from .session import build_session
    spark = build_session(app="tickerpulse-publish")
    audit, paths = Observation("rules"), {}

    def write(folder: str) -> dict[str, str]:
        made = run(spark, a.hashtag, a.cashtag, folder, multi_line=not a.lines, strict_compat=a.strict, k=a.k, audit=audit)
        paths.update(made)
        return {n: p for n, p in made.items() if n != "quarantine"}
    if a.versions:
        print(f"version\t{publish_version(spark, a.out, write)}")
    else:
        write(a.out)
    for name, path in paths.items():
        print(f"{name}\t{path}")
    for name, rows in audit.get.items():
        print(f"{name}\t{rows}")


if __name__ == "__main__":
    main()
