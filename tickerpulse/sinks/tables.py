"""Publishing results as tables.

The default store is Parquet folders under a base path (on a cluster: the
shared folder); JDBC is available through the same call. Before many
tables are derived from one post fact, the fact is stored once as Parquet:
that cuts the lineage (an executor loss re-reads the stored files instead
of re-parsing and re-identifying the raw input) and every table is then
derived from a columnar, pruned scan.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import JDBC_BATCH_SIZE, ROLL_BYTES
from ..functions.arrays import flatten_for_sink
from ..operators import counts, market, ranking
from ..operators.facts import explode_pairs
from ..session import staged


def write_table(df: DataFrame, name: str, base_path: str | None = None, mode: str = "overwrite",
                fmt: str = "parquet", partition_by: list[str] | None = None,
                jdbc: dict[str, str] | None = None, flatten: bool = True,
                rebalance: bool = True) -> str:
    """Write ``df`` as table ``name``. Arrays are joined to comma strings for
    flat stores (always for JDBC). Returns the folder or the JDBC table name.

    A partitioned write is rebalanced by the partition columns first (one
    shuffle of the table); pass ``rebalance=False`` when the input is
    already clustered by them (e.g. time-rolled files and a date column)."""
    out = flatten_for_sink(df) if (flatten or jdbc) else df
    if jdbc is not None:
        # numPartitions caps concurrent connections (Spark coalesces to it)
        (out.write.format("jdbc").mode(mode)
         .option("dbtable", name).option("batchsize", str(JDBC_BATCH_SIZE))
         .option("numPartitions", "8").options(**jdbc).save())
        return name
    path = os.path.join(base_path, name)
    if partition_by and rebalance:
        out = rebalanced(out, partition_by)
    w = out.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def rebalanced(df: DataFrame, cols: list[str]) -> DataFrame:
    """Group rows by the output partition columns before a partitioned write.

    Without it every task writes a file into every folder (tasks x folders
    small files). ``rebalance`` shuffles by the columns and lets AQE split
    a hot folder's rows over several tasks and merge small ones, so files
    come out near the advisory partition size.
    """
    return df.hint("rebalance", *cols)


def read_table(spark: SparkSession, name: str, base_path: str | None = None, fmt: str = "parquet",
               jdbc: dict[str, str] | None = None) -> DataFrame:
    if jdbc is not None:
        return spark.read.format("jdbc").option("dbtable", name).options(**jdbc).load()
    return spark.read.format(fmt).load(os.path.join(base_path, name))


def write_rolled(df: DataFrame, path: str, roll_bytes: int = ROLL_BYTES, partition_by: str = "date") -> str:
    """Line-delimited JSON files of about ``roll_bytes`` per date folder: splittable
    pieces instead of one growing document.

    Spark rolls by rows, so the rows per file follow from the average size of a
    row's JSON (one aggregate over the data); no row is dropped.
    """
    size = df.select(F.avg(F.octet_length(F.to_json(F.struct(*df.columns))) + 1).alias("b")).first()["b"]
    rows = max(1, int(roll_bytes / size)) if size else 1
    (rebalanced(df, [partition_by]).write.mode("overwrite").option("maxRecordsPerFile", rows)
     .partitionBy(partition_by).json(path))
    return path


def write_bars_json(bars: DataFrame, path: str) -> str:
    """Bars as well-formed line-delimited JSON."""
    bars.write.mode("overwrite").json(path)
    return path


def publish_all(fact: DataFrame, base_path: str, k: int = 5,
                jdbc: dict[str, str] | None = None, concurrency: int = 8,
                sources: list[str] | None = None, rebalance: bool = True) -> dict[str, str]:
    """Derive and write the published table set from one stored post fact.

    With the Parquet store the fact is written once, as the ``posts`` table
    (arrays kept, partitioned by ``date``), and every other table is
    derived from reading it back: the text is not copied to a scratch
    stage first. With JDBC the fact is staged in the shared scratch folder
    and ``posts`` is written flattened like the other tables.
    The derived tables are independent, so up to ``concurrency`` writes are
    submitted at once from driver threads; each is an ordinary distributed
    job, and small tables no longer leave the cluster idle between jobs.
    ``sources`` keeps only posts of the named collectors (default: all).
    """
    if sources is not None:
        fact = fact.where(F.col("source").isin(list(sources)))
    cols = fact.select("id", "source", "author_id", "created_at", "date", "month", "day", "hour",
                       "like_count", "quote_count", "reply_count", "retweet_count",
                       "text", "tickers", "tags")
    paths: dict[str, str] = {}
    if jdbc is None:
        paths["posts"] = write_table(cols, "posts", base_path, partition_by=["date"], flatten=False,
                                     rebalance=rebalance)
        f = read_table(cols.sparkSession, "posts", base_path)
    else:
        f = staged(cols, "post-fact")
    daily = counts.ticker_daily_count(f)
    hourly = counts.ticker_tag_hourly(f)
    flat = counts.flat_posts(f)
    pairs = explode_pairs(f, keep_cols=("month", "day", "hour"))
    # FIXED VALUES: names of the published tables and of their columns
    tables = {
        "timing_union_df": f.drop("id", "source", "author_id", "date"),
        "timing_time_tickers_tags_df": f.select("month", "day", "hour", "tickers", "tags"),
        "mdhr_tags": flat,
        "top_tags": counts.top_tags(f),
        "top5_stock_statistics_new": counts.ticker_statistics(f),
        "tag_freq_new": counts.ticker_freq_top(f, k),
        "test_days_list": counts.daily_total(f),
        "popular_tags_daily_count_new": ranking.top_daily(daily, k),
        "popular_tags_hourly_count_new": ranking.top_hourly_tags(hourly, k),
        "timing_ticker_freq_df": counts.ticker_set_freq(f),
        "timing_time_tickers_tags_explode_df": pairs.select(
            "month", "day", "hour", F.col("ticker").alias("tickers"), F.col("tag").alias("tags")),
    }
    if jdbc is not None:
        tables["posts"] = f.select("id", "text", "tickers", "tags", "created_at")
    with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
        futures = {name: pool.submit(write_table, df, name, base_path, jdbc=jdbc)
                   for name, df in tables.items()}
        paths.update({name: fut.result() for name, fut in futures.items()})
    return paths


def publish_bars(ticks: DataFrame, base_path: str, jdbc: dict[str, str] | None = None) -> dict[str, str]:
    """The two bar tables: ``stocks_hourly`` and ``stocks_monthly`` (one bar a day),
    partitioned by date. Ticks are read once; the days are rolled up from the stored hours."""
    paths = {"stocks_hourly": write_table(market.hourly_bars(ticks), "stocks_hourly", base_path,
                                          partition_by=None if jdbc else ["date"], jdbc=jdbc)}
    hourly = read_table(ticks.sparkSession, "stocks_hourly", base_path, jdbc=jdbc)
    paths["stocks_monthly"] = write_table(market.daily_from_hourly(hourly), "stocks_monthly", base_path,
                                          partition_by=None if jdbc else ["date"], jdbc=jdbc)
    return paths


def fetch_bounded(df: DataFrame, max_rows: int):
    """A small result for a consumer (chart, API) as pandas, only at the edge.

    At most ``max_rows + 1`` rows are pulled; a larger result raises
    instead of filling the driver.
    """
    pdf = df.limit(max_rows + 1).toPandas()
    if len(pdf) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows")
    return pdf


def price_day(view: DataFrame, ticker: str, day: str, max_rows: int):
    """One (ticker, day) of the precomputed price-day view, ordered by hour; the caller
    says how many rows a day may have."""
    v = view.where((F.col("ticker") == ticker) & (F.col("date") == F.to_date(F.lit(day))))
    return fetch_bounded(v.orderBy("hour"), max_rows)
