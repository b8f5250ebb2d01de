"""Live job: envelope files dropped into the collectors' folders -> identified
posts, hourly counts and unreadable documents.

    python -m tickerpulse.streaming.live --hashtag /drop/h --cashtag /drop/c --out /shared/live --checkpoint /shared/ckpt

One query reads both folders. Each micro-batch re-closes unclosed documents,
keeps those that stay unreadable in ``quarantine``, drops known spam from the
hashtag collector, identifies once, stores its posts by date and counts from
what it stored. Posts and unreadable documents go to ``batch=<id>`` folders,
which a batch that runs again overwrites; those of posts are compacted into
larger ones as they grow in number (``segments``), so read them by ``posts``.
The counts are a table by day, of which a batch replaces the days it touches.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import TICKERS
from ..publish_job import identified
from ..schemas import FACT
from ..sources.envelopes import corrupt_files, repair_unclosed
from .days import read_days, remove, replace_days
from .jobs import MAX_FILES, envelope_stream, hourly_partials, totals
from .segments import compact, read_segments

_HOURLY = "t_hour timestamp_ntz, ticker string, cnt long, date date"


def start(spark: SparkSession, sources: dict[str, str], out_dir: str, ckpt_dir: str, universe=TICKERS,
          trigger: dict | None = None, max_records_per_file: int = 100_000,
          max_files_per_trigger: int = MAX_FILES, multi_line: bool = True) -> StreamingQuery:
    """Start the query. ``sources`` maps a collector's name (``hashtag``, ``cashtag``) to its
    folder; ``trigger`` defaults to one micro-batch a minute, each reading at most
    ``max_files_per_trigger`` new files of each folder."""
    streams = [envelope_stream(spark, folder, multi_line=multi_line, max_files_per_trigger=max_files_per_trigger)
               .withColumn("source", F.lit(name)) for name, folder in sources.items()]

    def write(batch: DataFrame, batch_id: int) -> None:
        here = lambda name: os.path.join(out_dir, name, f"batch={batch_id}")
        env = repair_unclosed(batch)
        corrupt_files(env).write.mode("overwrite").json(here("quarantine"))
        fact = identified(env, universe)
        compact(spark, os.path.join(out_dir, "posts"), FACT, "date", batch_id)
        (fact.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
         .partitionBy("date").parquet(here("posts")))
        if (stored := _stored(spark, os.path.join(out_dir, "posts"), batch_id)) is not None:
            mentions = stored.select("created_at", F.explode("tickers").alias("ticker"))
            hourly_partials(mentions).withColumn("date", F.to_date("t_hour")).write.mode("overwrite").parquet(here("hourly_parts"))
            replace_days(spark.read.schema(_HOURLY).parquet(here("hourly_parts")), os.path.join(out_dir, "hourly"), "date", batch_id,
                         lambda old, new: totals(old.unionByName(new), ["date", "t_hour", "ticker"]))
            remove(spark, here("hourly_parts"))

    return (reduce(DataFrame.unionByName, streams).writeStream.foreachBatch(write)
            .option("checkpointLocation", ckpt_dir).trigger(**(trigger or {"processingTime": "1 minute"})).start())


def _stored(spark: SparkSession, folder: str, batch_id: int) -> DataFrame | None:
    """The posts a batch has written; None for a batch without posts."""
    path = f"{folder}/batch={batch_id}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not any(s.isDirectory() for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)):
        return None
    return spark.read.parquet(path)


def posts(spark: SparkSession, out_dir: str) -> DataFrame:
    """All posts stored so far, each once."""
    return read_segments(spark, os.path.join(out_dir, "posts"), FACT)


def hourly_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """(t_hour, ticker, cnt) of all posts stored so far."""
    schema = spark.createDataFrame([], _HOURLY).schema
    return read_days(spark, os.path.join(out_dir, "hourly"), schema, "date").drop("date")


def unreadable(spark: SparkSession, out_dir: str) -> DataFrame:
    """Number of documents kept in quarantine."""
    return spark.read.schema("_corrupt_record string").json(os.path.join(out_dir, "quarantine")) \
        .agg(F.count(F.lit(1)).alias("documents"))


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="envelope drops -> posts and hourly counts")
    ap.add_argument("--hashtag", help="drop folder of the hashtag collector")
    ap.add_argument("--cashtag", help="drop folder of the cashtag collector")
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint", required=True)
    a = ap.parse_args(argv)
    sources = {k: v for k, v in (("hashtag", a.hashtag), ("cashtag", a.cashtag)) if v}
    if not sources:
        ap.error("no drop folder given")
    from ..session import build_session
    spark = build_session(app="tickerpulse-live")
    q = start(spark, sources, a.out, a.checkpoint)
    print(f"started {q.id}")
    q.awaitTermination()


if __name__ == "__main__":
    main()
