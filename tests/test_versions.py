"""Versioned table sets, one row per post, counts observed while writing."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tickerpulse.operators.quality import apply_rules, filter_audit
from tickerpulse.operators.upsert import latest_posts, upsert_posts
from tickerpulse.session import staged
from tickerpulse.sinks.tables import write_table
from tickerpulse.sinks.versions import current_version, manifest, publish_version, read_published
from tickerpulse.streaming.days import read_days

POST = "id string, date date, like_count long, seen_at timestamp_ntz, sources array<string>"


def _set(spark, n, fail=False):
    def write(folder):
        paths = {"a": write_table(spark.range(n), "a", folder)}
        if fail:
            raise RuntimeError("killed")
        return paths | {"b": write_table(spark.range(2 * n), "b", folder)}
    return write


def test_readers_see_one_run_or_the_one_before(spark, tmpdir_path):
    base = f"{tmpdir_path}/set"
    assert current_version(spark, base) is None
    with pytest.raises(FileNotFoundError):
        manifest(spark, base)
    assert publish_version(spark, base, _set(spark, 3)) == 1
    with pytest.raises(RuntimeError, match="killed"):
        publish_version(spark, base, _set(spark, 5, fail=True))
    assert current_version(spark, base) == 1
    assert [read_published(spark, base, t).count() for t in "ab"] == [3, 6]
    assert publish_version(spark, base, _set(spark, 7)) == 3
    assert [read_published(spark, base, t).count() for t in "ab"] == [7, 14]
    assert [read_published(spark, base, t, 1).count() for t in "ab"] == [3, 6]  # still there for its readers
    assert sorted(os.listdir(base)) == ["manifests", "version=1", "version=3"]  # the killed run's folder is gone
    publish_version(spark, base, _set(spark, 8))
    assert sorted(os.listdir(base)) == ["manifests", "version=3", "version=4"]


def test_a_number_is_published_once(spark, tmpdir_path):
    base = f"{tmpdir_path}/set"

    def overtaken(folder):
        os.makedirs(f"{base}/manifests")
        with open(f"{base}/manifests/1", "w") as f:
            f.write("{}")
        return {"a": write_table(spark.range(1), "a", folder)}
    with pytest.raises(RuntimeError, match="another run"):
        publish_version(spark, base, overtaken)
    assert manifest(spark, base) == {}
    with pytest.raises(ValueError, match="outside"):
        publish_version(spark, base, lambda folder: {"a": f"{tmpdir_path}/elsewhere"})


def _posts(spark, rows):
    return staged(spark.sql(" UNION ALL ".join(
        f"SELECT {i} AS id, DATE'{d}' AS date, CAST({n} AS bigint) AS like_count, TIMESTAMP_NTZ'{d} {t}' AS seen_at, array('{s}') AS sources"
        for i, d, n, t, s in rows)), "upsert-test")


def test_upsert_keeps_the_row_seen_last(spark, tmpdir_path):
    first = _posts(spark, [("'1'", "2022-11-01", 1, "03:00:00", "h"), ("'1'", "2022-11-01", 4, "05:00:00", "c"),
                           ("'2'", "2022-11-02", 9, "03:00:00", "h")])
    later = _posts(spark, [("'1'", "2022-11-01", 2, "04:00:00", "h"), ("'2'", "2022-11-02", 3, "09:00:00", "c"),
                           ("'3'", "2022-11-03", 0, "01:00:00", "c")])
    path = f"{tmpdir_path}/posts"
    for n, rows in enumerate((first, later, first, later, later)):  # given again: nothing changes
        upsert_posts(rows, path, n)
    upsert_posts(later, path, 4)
    got = {r["id"]: (r["like_count"], r["sources"]) for r in read_days(spark, path, first.schema, "date").collect()}
    assert got == {"1": (4, ["c", "h"]), "2": (3, ["c", "h"]), "3": (0, ["c"])}


def test_latest_of_ties_nulls_and_no_rows(spark):
    rows = [("1", None, 5, None, ["h"]), ("1", None, 7, None, ["h"]), (None, None, 1, None, ["c"]), (None, None, 1, None, ["c"]),
            ("2", None, None, None, None)]
    df = spark.createDataFrame(rows, POST)
    got = sorted(((r["id"] or "", r["like_count"], r["sources"]) for r in latest_posts(df).collect()), key=str)
    assert [g[:2] for g in got] == [("", 1), ("", 1), ("1", 7), ("2", None)]
    assert latest_posts(df.limit(0)).count() == 0 and latest_posts(df).columns == df.columns


def test_observed_counts_equal_the_audit(spark, tmpdir_path):
    rules = [("AAPL", ["SPAM"], None), ("MU", None, "buy")]
    rows = [("h", ["AAPL"], ["SPAM"], "a"), ("h", ["AAPL"], [], "a"), ("h", ["MU"], [], "buy now"), ("c", ["MU"], [], "buy now"), ("h", None, [], None)]
    df = spark.createDataFrame(rows, "source string, tickers array<string>, tags array<string>, text string")
    audit = Observation("all")
    kept = apply_rules(df, rules, audit=audit)
    kept.write.parquet(f"{tmpdir_path}/kept")
    assert audit.get == filter_audit(df, rules).first().asDict()
    assert spark.read.parquet(f"{tmpdir_path}/kept").count() == audit.get["after_rule_2"]
    one = Observation("hashtag")
    apply_rules(df, rules, only_source="h", audit=one).write.parquet(f"{tmpdir_path}/one")
    assert one.get == filter_audit(df.where(F.col("source") == "h"), rules).first().asDict()
    assert spark.read.parquet(f"{tmpdir_path}/one").count() == one.get["after_rule_2"] + 1
