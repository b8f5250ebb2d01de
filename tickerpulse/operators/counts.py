"""Mention counts. Every ``groupBy`` here is a partial + final hash
aggregate, so a hot symbol or the NULL group is combined map-side before
the shuffle and never reaches one task as raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import STOP_TAG
from ..functions.arrays import join_array
from ..functions.timeparts import bucket
from .facts import explode_tickers


def ticker_set_freq(fact: DataFrame) -> DataFrame:
    """Posts per whole ``tickers`` array; the array is joined for the sink."""
    g = fact.groupBy("tickers").agg(F.count(F.lit(1)).alias("cnt"))
    return g.select(join_array("tickers").alias("tickers"), "cnt")


def ticker_statistics(fact: DataFrame) -> DataFrame:
    """Per ticker (NULL group kept): posts, retweet sum, and their sum."""
    m = explode_tickers(fact, keep_cols=("retweet_count",))
    g = m.groupBy("ticker").agg(F.count(F.lit(1)).alias("cnt"),
                                F.sum("retweet_count").alias("retweets"))
    return g.select(F.concat_ws(",", "ticker").alias("tickers"), "cnt", "retweets",
                    (F.col("cnt") + F.col("retweets")).alias("final_result"))


def ticker_freq(fact: DataFrame) -> DataFrame:
    m = explode_tickers(fact, keep_cols=())
    return m.groupBy(F.upper("ticker").alias("ticker")).agg(F.count(F.lit(1)).alias("cnt"))


def ticker_freq_top(fact: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` tickers by count (ties by ticker, NULL last): TakeOrderedAndProject."""
    return ticker_freq(fact).orderBy(F.desc("cnt"), F.asc_nulls_last("ticker")).limit(k)


def tag_freq_universe(fact: DataFrame, universe: DataFrame) -> DataFrame:
    """Tag frequency (upper) of tagged posts, kept to universe symbols.

    Counted first (map-side), so the semi join meets one row per tag.
    """
    t = fact.where(F.size("tags") > 0).select(F.explode("tags").alias("tag"))
    g = t.groupBy(F.upper("tag").alias("tag")).agg(F.count(F.lit(1)).alias("cnt"))
    return g.join(_as_tag(universe), "tag", "left_semi")


def ticker_daily_count(fact: DataFrame) -> DataFrame:
    m = explode_tickers(fact, keep_cols=("created_at",))
    d = m.select(bucket("created_at", "day").alias("t_day"), "ticker").where("t_day IS NOT NULL")
    return d.groupBy("t_day", F.col("ticker").alias("tag")).agg(F.count(F.lit(1)).alias("cnt"))


def daily_total(fact: DataFrame) -> DataFrame:
    m = explode_tickers(fact, keep_cols=("created_at",))
    d = m.select(bucket("created_at", "day").alias("t_day")).where("t_day IS NOT NULL")
    return d.groupBy("t_day").agg(F.count(F.lit(1)).alias("cnt"))


def ticker_tag_hourly(fact: DataFrame, stop_tag: str = STOP_TAG) -> DataFrame:
    """Hourly (ticker, co-tag) counts; NULL parts and the stop tag removed.

    The filter on grouping keys is pushed below the aggregate by Catalyst.
    """
    return clean_hourly(pair_counts_hourly(fact), stop_tag)


def _set_tag_counts(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tag counts per (keys, whole ticker set, tag), before any ticker x tag
    pair exists: ``n`` counts rows, ``c`` counts non-NULL tags. Posts that
    share a ticker set (a hot symbol) collapse here, map-side."""
    t = fact.select(*keys, "tickers", F.explode_outer("tags").alias("tags"))
    return t.groupBy(*keys, "tickers", "tags").agg(F.count(F.lit(1)).alias("n"),
                                                   F.count("tags").alias("c"))


def _expand_sets(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Aggregated (keys, ticker set, tag) rows -> (keys, ticker, tag) rows; a
    NULL or empty set gives one NULL ticker, as ``explode_outer`` does."""
    return counted.select(*keys, F.explode_outer("tickers").alias("tickers"), "tags", "n", "c")


LEVELS = {
    "hour": ("month", "day", "hour", "tickers", "tags"),
    "day": ("month", "day", "tickers", "tags"),
    "month": ("month", "tickers", "tags"),
}


def tag_counts(fact: DataFrame, level: str) -> DataFrame:
    """``count(tags)`` over the ticker x tag rows of each post, per level
    (NULL tags give 0-count groups). Counted per ticker set first, so the
    pairs are only formed on aggregated rows."""
    keys = LEVELS[level]
    time_keys = [k for k in keys if k not in ("tickers", "tags")]
    e = _expand_sets(_set_tag_counts(fact, time_keys), time_keys)
    return e.groupBy(*keys).agg(F.sum("c").cast("bigint").alias("cnt_t"))


def tag_counts_resum(counts: DataFrame, level: str, sort_desc: bool = False) -> DataFrame:
    """Second aggregation ``sum(cnt_t)`` over the same keys; ``sort_desc``
    orders by the sum, largest first (a range shuffle, so only for output)."""
    keys = LEVELS[level]
    out = counts.groupBy(*keys).agg(F.sum("cnt_t").alias("total"))
    return out.orderBy(F.desc("total"), *keys) if sort_desc else out


def tag_counts_rollup(hour_counts: DataFrame, level: str) -> DataFrame:
    """Day / month counts rolled up from the hour counts (no re-explode)."""
    keys = LEVELS[level]
    return hour_counts.groupBy(*keys).agg(F.sum("cnt_t").alias("cnt_t"))


def tag_counts_levels(fact: DataFrame) -> DataFrame:
    """All three levels in one pass with GROUPING SETS (one Expand, one shuffle)."""
    time_keys = ["month", "day", "hour"]
    e = _expand_sets(_set_tag_counts(fact, time_keys), time_keys)
    sets = [list(LEVELS["hour"]), list(LEVELS["day"]), list(LEVELS["month"])]
    return e.groupingSets(sets, *LEVELS["hour"]).agg(
        F.grouping_id().cast("bigint").alias("level"), F.sum("c").cast("bigint").alias("cnt_t")) \
        .select("month", "day", "hour", "tickers", "tags", "level", "cnt_t")


def pair_counts_hourly(fact: DataFrame) -> DataFrame:
    """Hourly (ticker, co-tag) counts over every pair, NULL parts included.

    Same counts as exploding ticker x tag per post, but tags are first
    counted per (hour, ticker set): the pair expansion then runs on
    aggregated rows, so a symbol held by a third of all posts is combined
    map-side before any pair is formed.
    """
    h = fact.select(bucket("created_at", "hour").alias("t_hour"), "tickers", "tags")
    e = _expand_sets(_set_tag_counts(h, ["t_hour"]), ["t_hour"])
    return e.groupBy("t_hour", F.col("tickers").alias("tag"), F.col("tags").alias("ref_tag")) \
        .agg(F.sum("n").cast("bigint").alias("cnt"))


def clean_hourly(counts_df: DataFrame, stop_tag: str = STOP_TAG) -> DataFrame:
    """Drop groups with a NULL part or the stop co-tag."""
    return counts_df.where(F.col("t_hour").isNotNull() & F.col("tag").isNotNull()
                           & F.col("ref_tag").isNotNull() & (F.col("ref_tag") != stop_tag))


def drop_self_tags(flat: DataFrame, explode_tickers_first: bool = True) -> DataFrame:
    """Exploded (ticker, tag) rows of the flat table without empty or self tags.

    With ``explode_tickers_first`` each ticker of a multi-ticker post is its
    own row; ``False`` keeps the joined ticker string (so a tag only equals
    it for single-ticker posts).
    """
    f = flat
    if explode_tickers_first:
        f = f.withColumn("tickers", F.explode_outer(F.split("tickers", ",")))
    e = f.withColumn("tags", F.explode_outer(F.split("tags", ",")))
    return e.where(F.col("tags") != "").where(F.col("tags") != F.col("tickers"))


def flat_posts(fact: DataFrame) -> DataFrame:
    """month, day, hour with tickers and tags joined into comma strings."""
    return fact.select("month", "day", "hour", join_array("tickers").alias("tickers"),
                       join_array("tags").alias("tags"))


def top_tags(fact: DataFrame) -> DataFrame:
    """``times`` per (ticker, date, month, day, hour, tag) over the ticker x tag
    rows of each post, without empty and self tags; a post without tickers has
    the ticker ``''``.

    Tags are counted per whole ticker set first, so pairs only form on
    aggregated rows; the date keeps equal days of different years apart.
    """
    keys = ["date", "month", "day", "hour"]
    t = fact.select(*keys, "tickers", F.explode("tags").alias("tags")).where(F.col("tags") != "")
    c = t.groupBy(*keys, "tickers", "tags").agg(F.count(F.lit(1)).alias("n"))
    e = c.select(*keys, F.explode_outer("tickers").alias("tickers"), "tags", "n") \
        .withColumn("tickers", F.coalesce("tickers", F.lit(""))).where(F.col("tags") != F.col("tickers"))
    return e.groupBy("tickers", *keys, "tags").agg(F.sum("n").alias("times"))


def distinct_by_group(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def dedup_statistics(fact: DataFrame, universe: DataFrame,
                     cols=("author_id", "created_at", "like_count", "quote_count", "reply_count",
                           "retweet_count", "text", "tags")) -> DataFrame:
    """Statistics per universe tag after removing duplicate mention rows
    (rows equal in every post column and the tag). ``universe`` has one column."""
    posts = fact.where(F.size("tags") > 0).select(*cols).dropDuplicates()
    t = posts.select("retweet_count", F.explode(F.array_distinct("tags")).alias("tag"))
    # every tag is counted map-side before the few universe tags are looked up
    g = t.groupBy("tag").agg(F.count(F.lit(1)).alias("cnt"), F.sum("retweet_count").alias("retweets")) \
        .join(_as_tag(universe), "tag", "left_semi")
    return g.select("tag", "cnt", "retweets", (F.col("cnt") + F.col("retweets")).alias("final_result"))


def _as_tag(universe: DataFrame) -> DataFrame:
    return universe.select(F.col(universe.columns[0]).alias("tag"))


def cotags_hourly_dedup(fact: DataFrame, universe: DataFrame) -> DataFrame:
    """Hourly (universe tag, non-universe co-tag) counts over distinct mentions.

    A mention is distinct by author, time, tags and text, so a pair's count is
    the number of such posts that hold both: posts are counted per (hour, tag
    set), and only those rows are expanded into pairs. ``universe`` has one column.
    """
    posts = fact.where(F.size("tags") > 0) \
        .select("author_id", "created_at", "tags", F.sha2("text", 256).alias("text")).dropDuplicates()
    sets = posts.select(bucket("created_at", "hour").alias("t_hour"), F.array_sort(F.array_distinct("tags")).alias("tags")) \
        .groupBy("t_hour", "tags").agg(F.count(F.lit(1)).alias("n"))
    u = _as_tag(universe)
    t = sets.select("t_hour", F.explode("tags").alias("tag"), "tags", "n").join(u, "tag", "left_semi")
    r = t.select("t_hour", "tag", F.explode("tags").alias("ref_tag"), "n") \
        .groupBy("t_hour", "tag", "ref_tag").agg(F.sum("n").alias("cnt"))
    return r.join(u.withColumnRenamed("tag", "ref_tag"), "ref_tag", "left_anti").select("t_hour", "tag", "ref_tag", "cnt")


def filter_counts(df: DataFrame, stages: dict[str, object]) -> DataFrame:
    """Rows of ``df`` passing each named predicate (``None`` = all rows) as
    (stage, rows), counted in one pass over ``df``."""
    aggs = [(F.count(F.lit(1)) if pred is None else F.count(F.when(pred, F.lit(1)))).alias(f"c{i}")
            for i, pred in enumerate(stages.values())]
    one = df.agg(*aggs)
    pairs = ", ".join(f"'{name}', c{i}" for i, name in enumerate(stages))
    return one.selectExpr(f"stack({len(stages)}, {pairs}) AS (stage, rows)")
