"""Spam rules as plain Column predicates (three-valued logic preserved).

A rule names a symbol and either a set of tags or a text prefix; a post is
dropped when it mentions the symbol and has any of the tags / starts with
the prefix. Predicates are *keep* conditions evaluated like SQL ``WHERE``:
a row survives only when the condition is TRUE, so posts whose
``tickers`` is NULL survive unless the tag / text half is FALSE.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..constants import SPAM_RULES

Rule = tuple[str, Sequence[str] | None, str | None]


def keep_condition(rule: Rule, tickers: str = "tickers", tags: str = "tags",
                   text: str = "text") -> Column:
    symbol, any_tags, prefix = rule
    not_about = ~F.array_contains(F.col(tickers), symbol)
    parts = []
    if any_tags:
        parts.append(reduce(lambda a, b: a & b,
                            [~F.array_contains(F.col(tags), t) for t in any_tags]))
    if prefix is not None:
        parts.append(~F.col(text).startswith(prefix))
    if not parts:
        return not_about
    return not_about | reduce(lambda a, b: a & b, parts)


def apply_rules(df: DataFrame, rules: Iterable[Rule] = SPAM_RULES,
                only_source: str | None = None, source_col: str = "source",
                audit: Observation | None = None) -> DataFrame:
    """Keep the rows that pass every rule. With ``only_source`` the rules
    apply to that collector's posts only (as the spam came through the
    hashtag collector); rows of other sources pass unchanged.

    ``audit`` receives the counts of ``filter_audit`` from the first job that
    writes the result, without a scan of its own. A stage that is run again
    after a lost executor may count its rows again."""
    rules = list(rules)
    judged = None if only_source is None else F.col(source_col).eqNullSafe(only_source)
    if audit is not None:
        df = df.observe(audit, *_audit_counts(rules, judged))
    conds = [keep_condition(r) for r in rules]
    if not conds:
        return df
    keep = reduce(lambda a, b: a & b, conds)
    return df.where(keep if judged is None else ~judged | keep)


def _audit_counts(rules: Sequence[Rule], judged: Column | None = None) -> list[Column]:
    """Rows (of those ``judged``) before and after each successive rule."""
    acc = F.lit(True) if judged is None else judged
    counts = [F.count(F.when(acc, F.lit(1))).alias("rows_in")]
    for i, r in enumerate(rules, start=1):
        acc = acc & keep_condition(r)
        counts.append(F.count(F.when(acc, F.lit(1))).alias(f"after_rule_{i}"))
    return counts


def filter_audit(df: DataFrame, rules: Sequence[Rule] = SPAM_RULES) -> DataFrame:
    """Rows before and after each successive rule, in one pass over ``df``."""
    return df.agg(*_audit_counts(rules))


def posts_about(df: DataFrame, symbol: str) -> DataFrame:
    return df.where(F.array_contains("tickers", symbol))


def tagged_posts(df: DataFrame, col: str = "tags") -> DataFrame:
    return df.where(F.size(col) > 0)
