"""Compaction of stream outputs: every row once, a bounded number of files, whatever a killed job leaves."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tickerpulse import schemas
from tickerpulse.streaming import jobs, live, segments
from tickerpulse.streaming.days import folders

DAY = dt.date(2024, 1, 1)
SCHEMA = "id long, date date"


def _batches(spark, table, upto, start=0):
    schema = spark.createDataFrame([], SCHEMA).schema
    for n in range(start, upto):
        segments.compact(spark, table, schema, "date", n)
        rows = [(n, DAY), (n, None)] if n % 3 else []
        spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").partitionBy("date").parquet(f"{table}/batch={n}")
    return schema


def _ids(spark, table, schema):
    return sorted((r["id"], str(r["date"])) for r in segments.read_segments(spark, table, schema).collect())


def _want(upto):
    return sorted((n, d) for n in range(upto) if n % 3 for d in (str(DAY), "None"))


def test_rows_once_and_few_folders(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(segments, "FAN", 3)
    schema = _batches(spark, tmpdir_path, 32)
    assert _ids(spark, tmpdir_path, schema) == _want(32)
    now = segments._current(spark, tmpdir_path)
    assert sorted(now) == ["batch=30", "batch=31", "segment=0-27", "segment=27-30"]
    assert len(os.listdir(tmpdir_path)) <= 2 * len(now) + 3  # what the last segment replaced is still there
    files = [f for _, _, fs in os.walk(os.path.join(tmpdir_path, "segment=0-27")) for f in fs if f.endswith(".parquet")]
    assert len(files) == 2  # a file for each of the two days


def test_killed_compaction_loses_and_doubles_nothing(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(segments, "FAN", 3)
    schema = _batches(spark, tmpdir_path, 9)
    path = segments.compact(spark, tmpdir_path, schema, "date", 9)
    assert path.endswith("segment=0-9") and _ids(spark, tmpdir_path, schema) == _want(9)
    os.remove(os.path.join(path, "_SUCCESS"))  # as if killed before the end
    assert _ids(spark, tmpdir_path, schema) == _want(9)
    _batches(spark, tmpdir_path, 19, start=9)  # the batch runs again
    assert _ids(spark, tmpdir_path, schema) == _want(19)
    again = segments.compact(spark, tmpdir_path, schema, "date", 18)  # a batch that failed after its compaction
    assert again.endswith("segment=9-18") and _ids(spark, tmpdir_path, schema) == _want(19)


def test_unfinished_batch_is_not_read(spark, tmpdir_path):
    schema = _batches(spark, tmpdir_path, 3)
    os.remove(os.path.join(tmpdir_path, "batch=2", "_SUCCESS"))
    assert _ids(spark, tmpdir_path, schema) == _want(2)
    assert segments.read_segments(spark, os.path.join(tmpdir_path, "nothing"), schema).count() == 0


def test_files_are_rolled_by_bytes(spark, tmpdir_path):
    schema = "id long, text string, date date"
    for n in range(10):
        (spark.range(n * 1000, (n + 1) * 1000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"), F.lit(DAY).alias("date"))
         .coalesce(1).write.partitionBy("date").parquet(f"{tmpdir_path}/batch={n}"))
    path = segments.compact(spark, tmpdir_path, spark.createDataFrame([], schema).schema, "date", 10, roll_bytes=100_000)
    sizes = sorted(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))
    assert len(sizes) > 5 and sizes[-1] < 150_000
    assert spark.read.parquet(path).select("id").distinct().count() == 10_000


def test_stream_over_many_batches(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(segments, "FAN", 3)
    src, out, ckpt = (os.path.join(tmpdir_path, x) for x in ("src", "out", "ckpt"))
    spark.range(0, 110, 1, 11).select("id", F.when(F.col("id") % 7 != 0, F.date_add(F.lit(DAY), (F.col("id") % 2).cast("int"))).alias("date")) \
        .write.parquet(src)
    for _ in range(2):  # the second run finds nothing new
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        got = jobs.run_compacted(stream, "t-compacted", "date", out, ckpt)
        assert sorted(r["id"] for r in got.collect()) == list(range(110))
        assert got.where("date IS NULL").count() == 16
    assert folders(spark, f"{out}/table", "segment=")


def test_live_posts_and_counts_over_many_batches(spark, tmpdir_path, monkeypatch):
    import json
    monkeypatch.setattr(segments, "FAN", 3)
    drop, out = os.path.join(tmpdir_path, "c"), os.path.join(tmpdir_path, "out")
    os.makedirs(drop)
    for i in range(8):
        post = {"data": {"id": str(i), "text": "$MU", "author_id": "a", "conversation_id": "c", "created_at": f"2022-11-0{1 + i % 2}T05:00:00.000Z",
                         "public_metrics": {"like_count": 0, "quote_count": 0, "reply_count": 0, "retweet_count": 0}}, "includes": {}}
        with open(os.path.join(drop, f"{i}.json"), "w") as f:
            f.write('{"tweets":[' + json.dumps(post) + ",{}]}")
    q = live.start(spark, {"cashtag": drop}, out, os.path.join(tmpdir_path, "ckpt"), universe=["MU"],
                   trigger={"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    posts = live.posts(spark, out)
    assert posts.schema == schemas.FACT and sorted(r["id"] for r in posts.collect()) == [str(i) for i in range(8)]
    assert sorted((r["t_hour"].day, r["cnt"]) for r in live.hourly_counts(spark, out).collect()) == [(1, 4), (2, 4)]
    assert folders(spark, f"{out}/posts", "segment=") and not folders(spark, f"{out}/hourly_parts", "batch=")
