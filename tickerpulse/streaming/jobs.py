"""Structured Streaming forms of the batch operators.

Identification, tag extraction and rule matching need no state, so the
batch functions run on each micro-batch. Counts are kept as one partial
count per (hour, key) and batch, added up when read or folded into the days
of a published table: open hours are part of the result, and a row counts
whenever it arrives, however late. In event time, with a watermark, the state
is the hours still open and late rows are reported. Deduplication looks up the
keys already written for the days of a batch.
Every query writes through a checkpoint in the shared folder, so a restarted
query resumes where it stopped, and a batch that runs again overwrites its
own folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.entities import symbol_candidates, symbol_lengths
from ..functions.timeparts import bucket
from ..session import scratch_path, staged
from .days import days_of, day_name, path_exists, read_days, replace_days, write_days
from .segments import compact, read_segments


#: New files a micro-batch takes at most, so a backlog is worked off in bounded batches.
MAX_FILES = 1000


def table_stream(spark: SparkSession, folder: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the table ``name`` of ``folder``: one Parquet file or a folder of them
    (schema from the footer).

    The last letter is written as a one-letter class: a file source takes a
    single file only through a glob, which matches a folder just as well.
    """
    path = f"{folder.rstrip('/')}/{name}.parquet"
    return (spark.readStream.schema(spark.read.parquet(path).schema)
            .option("maxFilesPerTrigger", max_files_per_trigger or MAX_FILES).parquet(path[:-1] + "[t]"))


def envelope_stream(spark: SparkSession, folder: str, multi_line: bool = False,
                    max_files_per_trigger: int | None = MAX_FILES) -> DataFrame:
    """Envelope JSON files dropped into ``folder``, read with the explicit
    schema; ``max_files_per_trigger`` bounds each micro-batch (a backlog
    after a restart is worked off in several batches)."""
    from .. import schemas
    r = (spark.readStream.schema(schemas.ENVELOPE).option("multiLine", multi_line)
         .option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(folder)


def hourly_partials(mentions: DataFrame, ts: str = "created_at", key: str = "ticker") -> DataFrame:
    """Counts per (hour, key) of one micro-batch, to be added up by ``totals``."""
    return mentions.groupBy(bucket(ts, "hour").alias("t_hour"), key).agg(F.count(F.lit(1)).alias("cnt"))


def totals(partials: DataFrame, keys: Sequence[str] = ("t_hour", "ticker")) -> DataFrame:
    """Partial counts of all batches added up."""
    return partials.groupBy(*keys).agg(F.sum("cnt").alias("cnt"))


def run_counts_by_day(mentions: DataFrame, name: str, out: str | None = None, ckpt: str | None = None,
                      ts: str = "created_at", key: str = "ticker") -> DataFrame:
    """Keep a table of hourly counts, partitioned by date, up to date with a stream.

    A micro-batch adds its counts to the days it touches and replaces those
    days; other days are not opened. Rows without a time are a day of their own.
    """
    spark = mentions.sparkSession
    table = f"{out or scratch_path(spark, f'{name}-out')}/table"

    def counted(batch: DataFrame) -> DataFrame:
        return hourly_partials(batch, ts, key).withColumn("date", F.to_date("t_hour"))

    def publish(batch: DataFrame, batch_id: int) -> None:
        replace_days(staged(counted(batch), f"{name}-part"), table, "date", batch_id,
                     lambda old, new: totals(old.unionByName(new), ["date", "t_hour", key]))

    _run(mentions, publish, ckpt or scratch_path(spark, f"{name}-ckpt"))
    schema = counted(spark.createDataFrame([], mentions.schema)).schema
    return read_days(spark, table, schema, "date").drop("date")


def event_time_counts(timed: DataFrame, delay: str, key: str) -> DataFrame:
    """(t_hour, key, cnt) of a stream with the time ``at``: in update mode the whole count of every
    (hour, key) that a batch changed, for hours that end after the watermark."""
    return (timed.withWatermark("at", delay).groupBy(F.window("at", "1 hour").alias("w"), key).agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("t_hour"), key, "cnt"))


def _timed(mentions: DataFrame, ts: str, key: str) -> DataFrame:
    """A watermark needs a timestamp with a zone; the session's is UTC, so hours are the same."""
    return mentions.select(F.col(ts).cast("timestamp").alias("at"), key)


def _upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``old`` with the rows of equal (t_hour, key) replaced by those of ``new``."""
    same = (F.col("t_hour") == F.col("_hour")) & F.col(key).eqNullSafe(F.col("_key"))
    return old.join(new.select(F.col("t_hour").alias("_hour"), F.col(key).alias("_key")), same, "left_anti").unionByName(new)


def run_event_time_counts(mentions: DataFrame, name: str, delay: str = "2 hours", out: str | None = None,
                          ckpt: str | None = None, ts: str = "created_at", key: str = "ticker") -> tuple[DataFrame, DataFrame]:
    """Hourly counts in event time: the counts table and what came too late.

    The stream's state holds the hours that may still grow, those that end
    after the watermark (the latest time seen less ``delay``); each batch
    upserts the counts that it changed into the table. An hour behind the
    watermark is final and leaves the state. Rows of such hours are not
    counted; the second table, (batch, rows_in, counted, late), says how many
    a batch had. Rows without a time belong to no hour and count as late.

    Late rows are the difference of what a batch read and what it added, as
    the query reports it: a run that is killed leaves the batches since its
    start out of the second table, the counts are not touched by that.
    """
    spark = mentions.sparkSession
    out = out or scratch_path(spark, f"{name}-out")
    table, ledger, late = f"{out}/table", f"{out}/ledger", f"{out}/late"
    counts = event_time_counts(_timed(mentions, ts, key).observe("read", F.count(F.lit(1)).alias("rows_in")), delay, key)

    def publish(batch: DataFrame, batch_id: int) -> None:
        new = staged(batch.withColumn("date", F.to_date("t_hour")), f"{name}-changed")
        old = replace_days(new, table, "date", batch_id, lambda old, new: _upserted(old, new, key))
        before = old.join(new.select("t_hour", F.col(key).alias("_key")).withColumnRenamed("t_hour", "_hour"),
                          (F.col("t_hour") == F.col("_hour")) & F.col(key).eqNullSafe(F.col("_key")), "left_semi")
        added = new.select("cnt").unionByName(before.select((-F.col("cnt")).alias("cnt"))).agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("counted"))
        added.write.mode("overwrite").parquet(f"{ledger}/batch={batch_id}")

    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "100000")
    q = (counts.writeStream.outputMode("update").option("checkpointLocation", ckpt or scratch_path(spark, f"{name}-ckpt"))
         .trigger(availableNow=True).foreachBatch(publish).start())
    q.awaitTermination()
    rows_in = [(p["batchId"], p["observedMetrics"]["read"]["rows_in"]) for p in q.recentProgress if "read" in p["observedMetrics"]]
    if rows_in:
        read = spark.createDataFrame(rows_in, "batch long, rows_in long")  # a row for each batch of this run
        added = spark.read.schema("counted long, batch long").parquet(ledger)
        (read.join(added, "batch").withColumn("late", F.col("rows_in") - F.col("counted"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(late))
    schema = "t_hour timestamp_ntz, " + key + " string, cnt long, date date"
    late_schema = "rows_in long, counted long, late long, batch long"
    lost = spark.read.schema(late_schema).parquet(late) if path_exists(spark, late) else spark.createDataFrame([], late_schema)
    return (read_days(spark, table, spark.createDataFrame([], schema).schema, "date").drop("date"),
            lost.select("batch", "rows_in", "counted", "late"))


def run_top_per_hour(mentions: DataFrame, name: str, k: int, delay: str = "2 hours", out: str | None = None,
                     ckpt: str | None = None, ts: str = "created_at", key: str = "ticker") -> DataFrame:
    """The ``k`` most frequent keys of every hour, kept while the stream runs: (t_hour, key, cnt, rank).

    Counts are those of ``event_time_counts``; what is stored beside the
    stream's state are k rows an hour. They are enough: counts only grow, so a
    key that is neither among an hour's stored k nor changed by a batch is
    still behind k others after it. Ties go to the smaller key, NULL last.
    Rows behind the watermark or without a time are not counted.
    """
    from ..operators.ranking import top_k_per
    spark = mentions.sparkSession
    table = f"{out or scratch_path(spark, f'{name}-out')}/table"
    order = [F.desc("cnt"), F.asc_nulls_last(key)]

    def leaders(rows: DataFrame) -> DataFrame:
        return top_k_per(rows, ["t_hour"], order, k)

    def publish(batch: DataFrame, batch_id: int) -> None:
        new = staged(leaders(batch).drop("rank").withColumn("date", F.to_date("t_hour")), f"{name}-changed")
        replace_days(new, table, "date", batch_id, lambda old, new: leaders(_upserted(old, new, key)).drop("rank"))

    counts = event_time_counts(_timed(mentions, ts, key), delay, key)
    (counts.writeStream.outputMode("update").option("checkpointLocation", ckpt or scratch_path(spark, f"{name}-ckpt"))
     .trigger(availableNow=True).foreachBatch(publish).start().awaitTermination())
    schema = spark.createDataFrame([], f"t_hour timestamp_ntz, {key} string, cnt long, date date").schema
    return leaders(read_days(spark, table, schema, "date").drop("date"))


def run_dedup(stream: DataFrame, name: str, keys: Sequence[str], day: str, out: str | None = None,
              ckpt: str | None = None) -> DataFrame:
    """The first row of each key: a micro-batch is reduced to one row per key and
    keys that earlier batches wrote are dropped.

    Equal keys must carry an equal ``day`` (a date), by which the output is
    laid out: a batch opens the folders of its own days alone, whatever the
    history. What is remembered is the output itself, so repeats are found
    however late they come.
    """
    spark = stream.sparkSession
    out = out or scratch_path(spark, f"{name}-out")

    def write(batch: DataFrame, batch_id: int) -> None:
        new = staged(batch.dropDuplicates([*keys, day]), f"{name}-batch")
        seen = read_days(spark, out, stream.schema, day, [day_name(d) for d in days_of(new, day)], before=batch_id, every=True)
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in [*keys, day]]
        first = new.join(seen.select(*[F.col(k).alias(f"_{k}") for k in [*keys, day]]), reduce(lambda a, b: a & b, same), "left_anti")
        write_days(first, out, day, batch_id)

    _run(stream, write, ckpt or scratch_path(spark, f"{name}-ckpt"))
    return read_days(spark, out, stream.schema, day, every=True)


def _run(stream: DataFrame, each, ckpt: str) -> None:
    """Everything available now, batch by batch, on a query that must end well."""
    q = stream.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True).foreachBatch(each).start()
    q.awaitTermination()


def run_compacted(stream: DataFrame, name: str, day: str, out: str | None = None, ckpt: str | None = None) -> DataFrame:
    """All rows of a stream as a table by ``day`` whose number of files stays bounded (``segments``)."""
    spark = stream.sparkSession
    table = f"{out or scratch_path(spark, f'{name}-out')}/table"

    def write(batch: DataFrame, batch_id: int) -> None:
        compact(spark, table, stream.schema, day, batch_id)
        batch.write.mode("overwrite").partitionBy(day).parquet(f"{table}/batch={batch_id}")

    _run(stream, write, ckpt or scratch_path(spark, f"{name}-ckpt"))
    return read_segments(spark, table, stream.schema)


def rule_hits(posts: DataFrame, symbols: DataFrame, id_col: str = "id",
              text_col: str = "text") -> DataFrame:
    """(post, symbol) pairs for posts naming a rule symbol: stream-static
    equi semi join on the symbol. The static side is stored first: its size is then
    known to the plan of a micro-batch, which does not shuffle candidates to meet a small one."""
    names = staged(symbols.select("symbol").distinct(), "rule-symbols")
    cand = posts.select(id_col, F.explode(symbol_candidates(text_col, symbol_lengths(names))).alias("symbol"))
    return cand.join(names, "symbol", "left_semi")


def run_available_now(df: DataFrame, name: str, partition_by: Sequence[str] | None = None,
                      max_records_per_file: int | None = None, out: str | None = None,
                      ckpt: str | None = None, per_batch=None) -> DataFrame:
    """Run ``df`` over everything available now into a Parquet folder in the
    shared scratch area and return all written rows as a batch DataFrame.

    Rows go through the file sink, or, with ``per_batch``, as that function of
    each micro-batch into ``batch=<id>`` folders. Passing the same ``out`` /
    ``ckpt`` again resumes: only input not yet committed is read. The result
    is empty only if nothing was ever written; an output that cannot be read
    raises.
    """
    spark = df.sparkSession
    out = out or scratch_path(spark, f"{name}-out")
    ckpt = ckpt or scratch_path(spark, f"{name}-ckpt")
    if per_batch is not None:
        schema = per_batch(spark.createDataFrame([], df.schema)).schema
        _run(df, lambda batch, batch_id: per_batch(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}"), ckpt)
    else:
        schema = df.schema
        w = (df.writeStream.outputMode("append").option("checkpointLocation", ckpt).trigger(availableNow=True)
             .format("parquet").option("path", out))
        if partition_by:
            w = w.partitionBy(*partition_by)
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", max_records_per_file)
        w.start().awaitTermination()
    if not path_exists(spark, out):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out).select(*schema.names)
