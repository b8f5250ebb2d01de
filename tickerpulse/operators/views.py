"""Dense, keyed result shapes for consumers (the data side of the charts).

Grids are generated from the observed time range with ``sequence`` inside
one row and exploded, then joined by key; nothing depends on row
positions, so a missing hour is a zero cell instead of a shifted chart.
The calendar grows with the time span covered, not with the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def leader_cube(leaders: DataFrame, drop_last_day: bool = True) -> DataFrame:
    """Every hour of every day from the first to the last (the last, partial
    day dropped by default) with the hour's leader label and count (0 when
    there is none). ``leaders``: t_hour, stock, cnt."""
    rng = leaders.agg(F.min("t_hour").alias("lo"), F.max("t_hour").alias("hi"))
    first = F.date_trunc("day", "lo").cast("timestamp_ntz")
    last_day = F.date_trunc("day", "hi").cast("timestamp_ntz")
    if drop_last_day:
        last_day = last_day - F.expr("INTERVAL 1 DAY")
    stop = last_day + F.expr("INTERVAL 23 HOURS")
    # an empty range (only a partial last day) yields no hours, not an error
    seq = F.when(stop >= first, F.sequence(first, stop, F.expr("INTERVAL 1 HOUR")))
    hours = rng.select(F.explode(seq).alias("t_hour"))
    cube = hours.join(leaders, "t_hour", "left")
    return cube.select("t_hour", F.to_date("t_hour").alias("day"), F.hour("t_hour").alias("hour"),
                       "stock", F.coalesce("cnt", F.lit(0).cast("bigint")).alias("cnt"))


def daily_frames(top_daily: DataFrame, k: int = 5, drop_last_day: bool = True) -> DataFrame:
    """k rank slots for every calendar day from the first to the last day
    (last excluded by default), filled from the daily top-k by key."""
    rng = top_daily.agg(F.min("t_day").alias("lo"), F.max("t_day").alias("hi"))
    stop = F.col("hi") - F.expr("INTERVAL 1 DAY") if drop_last_day else F.col("hi")
    seq = F.when(stop >= F.col("lo"), F.sequence("lo", stop, F.expr("INTERVAL 1 DAY")))
    days = rng.select(F.explode(seq).alias("t_day"))
    slots = days.select("t_day", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(k).cast("bigint"))).alias("rank"))
    j = slots.join(top_daily, ["t_day", "rank"], "left")
    return j.select("t_day", "rank", "tag", F.coalesce("cnt", F.lit(0).cast("bigint")).alias("cnt"))


def measures_long(stats: DataFrame) -> DataFrame:
    """(tickers, measure, value) from the wide statistics table."""
    return stats.unpivot(["tickers"], ["cnt", "retweets", "final_result"], "measure", "value")
