"""Top-k per time bucket.

``row_number() <= k`` over a partition is planned by Catalyst as a
``WindowGroupLimit`` before the shuffle (partial top-k per map task) and
after it, so only k rows per bucket and task cross the network. Ties are
broken by the label columns, which makes the cut deterministic.
Intermediate results are never globally sorted (that would add a range
shuffle); ordering is left to the consumer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import LEADER_JOINER


def top_k_per(df: DataFrame, part: Sequence[str], order: Sequence[Column], k: int,
              rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k) \
        .withColumn(rank_col, F.col(rank_col).cast("bigint"))


def top_daily(daily_counts: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` tickers per day from (t_day, tag, cnt)."""
    return top_k_per(daily_counts, ["t_day"], [F.desc("cnt"), F.asc_nulls_last("tag")], k)


def top_hourly_tags(hourly_counts: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` (ticker, co-tag) pairs per hour from (t_hour, tag, ref_tag, cnt)."""
    return top_k_per(hourly_counts, ["t_hour"],
                     [F.desc("cnt"), F.asc_nulls_last("tag"), F.asc_nulls_last("ref_tag")], k)


def hour_leader_label(ranked_hourly: DataFrame, joiner: str = LEADER_JOINER) -> DataFrame:
    """The rank-1 pair of each hour with its ``tag•ref_tag`` label."""
    return ranked_hourly.where(F.col("rank") == 1).select(
        "t_hour", F.concat(F.col("tag"), F.lit(joiner), F.col("ref_tag")).alias("stock"), "cnt")


def top_then_exclude(hourly_counts: DataFrame, exclude: Sequence[str], k: int = 5) -> DataFrame:
    """Rank first, then drop excluded symbols: hours may keep fewer than ``k`` rows."""
    return top_hourly_tags(hourly_counts, k).where(~F.col("tag").isin(list(exclude)))


def top_tags_per_hour(top_tags: DataFrame, k: int = 3) -> DataFrame:
    """Top ``k`` tags per (ticker, month, day, hour) by ``times``."""
    return top_k_per(top_tags, ["tickers", "date", "hour"],
                     [F.desc("times"), F.asc_nulls_last("tags")], k)
