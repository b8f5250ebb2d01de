"""Long one-line documents read by many tasks give the rows of the whole-document reader."""

import json
import os

from tickerpulse.sources.envelopes import (corrupt_files, envelopes_from_posts, flatten_envelope, flatten_no_context, read_envelopes,
                                           read_long_envelopes, repair_unclosed, write_long_envelopes)

#: Texts that look like the boundaries: inside JSON strings their quotes are escaped.
TEXTS = ['{"data": {"id": "x"}}, {}]}', '{"tweets": [', "], }, {", "plain", "", "é＃", "line\nbreak", '\\"data\\":', "long " * 500]


def _record(i, text, **more):
    return {"data": {"id": str(i), "text": text, "author_id": "a", "conversation_id": "c", "created_at": "2022-11-01T00:00:00.000Z",
                     "public_metrics": {"like_count": i, "quote_count": 0, "reply_count": 0, "retweet_count": 0}},
            "includes": {"tweets": [{"id": "c1", "text": '{"data":'}], "places": []}, **more}


def _write(folder, name, records, start='{"tweets": [', end="{}]}", separators=(", ", ": ")):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(start + "".join(json.dumps(r, separators=separators) + separators[0] for r in records) + end)


def _rows(env):
    return sorted(map(str, flatten_envelope(env).collect()))


def test_same_rows_as_whole_documents_however_split(spark, tmpdir_path):
    records = [_record(i, TEXTS[i % len(TEXTS)]) for i in range(400)]
    _write(tmpdir_path, "a.json", records)
    _write(tmpdir_path, "compact.json", [_record(1000 + i, t, matching_rules=[{"id": "1"}]) for i, t in enumerate(TEXTS)], separators=(",", ":"))
    _write(tmpdir_path, "unclosed.json", [_record(2000 + i, t) for i, t in enumerate(TEXTS)], end="")
    _write(tmpdir_path, "spaced.json", [_record(3000, "x")], start=' {\n "tweets" : [\n', end=" {} ] }\n")
    _write(tmpdir_path, "none.json", [])
    whole = _rows(repair_unclosed(read_envelopes(spark, tmpdir_path)))
    assert len(whole) == 400 + 2 * len(TEXTS) + 1
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "20k", "3001b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            env = read_long_envelopes(spark, tmpdir_path)
            assert _rows(env) == whole, size
            assert corrupt_files(env).count() == 0
        tasks = env.rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert tasks > 50  # one document, many tasks


def test_only_the_cut_record_is_unreadable(spark, tmpdir_path):
    _write(tmpdir_path, "cut.json", [_record(1, "#MU"), _record(2, "#MU")], end='{"data": {"id": "9", "te')
    _write(tmpdir_path, "after.json", [_record(3, "#MU")], end='{"data": {"id": "4"}, "includes": {"places": []}')
    _write(tmpdir_path, "other.json", [], start="no envelope", end="")
    env = read_long_envelopes(spark, tmpdir_path)
    assert sorted(r["id"] for r in flatten_no_context(env).collect()) == ["1", "2", "3"]
    bad = sorted(r[0] for r in corrupt_files(env).collect())
    assert len(bad) == 3 and "no envelope" in bad


def test_written_documents_are_long_and_unclosed(spark, tmpdir_path):
    posts = spark.range(0, 5000, 1, 3).selectExpr("cast(id as string) id", "'a' author_id", "timestamp_ntz'2024-01-01' created_at", "id like_count",
                                                  "0L quote_count", "0L reply_count", "0L retweet_count", "concat('t ', id) text")
    path = write_long_envelopes(envelopes_from_posts(posts), os.path.join(tmpdir_path, "long"))
    files = [os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-")]
    texts = [open(f).read() for f in files]
    assert len(files) == 3 and all(t.startswith('{"tweets": [{"data"') and "\n" not in t and t.count("tweets") == 1 for t in texts)
    got = flatten_no_context(read_long_envelopes(spark, path)).select("id", "text").collect()
    assert sorted(int(r["id"]) for r in got) == list(range(5000)) and all(r["text"] == f"t {r['id']}" for r in got)
    empty = write_long_envelopes(envelopes_from_posts(posts.where("false")), os.path.join(tmpdir_path, "empty"))
    assert read_long_envelopes(spark, empty).count() == 0
