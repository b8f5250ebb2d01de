"""Reply threads and the as-of join against plain versions."""

import random

from tickerpulse.operators.asof import asof_join
from tickerpulse.operators.threads import thread_context, with_threads


def plain_threads(rows):
    parent = {}
    for i, p, _ in rows:
        if i is not None:
            known = [x for x in (parent.get(i), p) if x is not None]
            parent[i] = min(known) if known else None

    def climb(i):
        depth, seen = 0, set()
        while parent[i] in parent:
            if i in seen:
                return None, None
            seen.add(i)
            i, depth = parent[i], depth + 1
        return i, depth
    out = []
    for i, p, _ in rows:
        if i is not None:
            out.append((i, *climb(i)))
        elif p in parent:
            root, depth = climb(p)
            out.append((None, root, None if depth is None else depth + 1))
        else:
            out.append((None, None, 0 if p is None else None))
    return sorted(out, key=str)


def ran(spark, rows):
    df = spark.createDataFrame(rows, "id string, replied_to string, text string")
    return sorted(((r["id"], r["root"], r["depth"]) for r in with_threads(df).collect()), key=str)


def test_threads_against_climbing(spark):
    draw = random.Random(1)
    rows = [(str(i), str(draw.randrange(-3, max(1, i))) if i else None, "t") for i in range(200)]
    rows += [(f"c{i}", f"c{i + 1}", "chain") for i in range(70)]                    # c70 is missing: c69 is the root
    rows += [("x", "y", "cycle"), ("y", "z", "cycle"), ("z", "x", "cycle"), ("w", "x", "leads in"), ("self", "self", "")]
    rows += [(None, "5", "no id"), (None, None, "alone"), ("7", "3", "repeated"), ("7", None, "repeated")]
    draw.shuffle(rows)
    assert ran(spark, rows) == plain_threads(rows)
    assert ran(spark, []) == []


def test_thread_context_ignores_conversation_ids(spark):
    rows = [("1", None, "$MU first", None), ("2", "1", "answer", "other"), ("3", "2", "#EBAY", None), ("4", None, "$MU", None), ("5", "5", "$AAPL", None)]
    df = spark.createDataFrame(rows, "id string, replied_to string, text string, conversation_id string")
    got = {r["id"]: r["tickers"] for r in thread_context(df, ["MU", "EBAY", "AAPL"]).collect()}
    assert got == {"1": ["EBAY", "MU"], "2": ["EBAY", "MU"], "3": ["EBAY", "MU"], "4": ["MU"], "5": ["AAPL"]}


def test_asof_against_search(spark):
    draw = random.Random(2)
    key = lambda: draw.choice(["hot"] * 30 + ["a", "b", "never", None])
    left = [(key(), draw.choice([None] + list(range(400)) * 3), i) for i in range(1500)]
    right = [(k, t, t / 2 if t % 7 else None) for k in ("hot", "a", "b", "z") for t in draw.sample(range(400), 25)] + [(None, 3, 1.0), ("hot", None, 2.0)]

    def plain(k, t):
        if k is None or t is None:
            return None, None
        return max(((rt, v) for rk, rt, v in right if rk == k and rt is not None and rt <= t), default=(None, None), key=lambda x: x[0])
    want = sorted(((*r, *plain(*r[:2])) for r in left), key=str)
    a, b = spark.createDataFrame(left, "k string, t int, n int"), spark.createDataFrame(right, "k string, rt int, v double")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            got = asof_join(a, b, "k", "t", "rt", ["v"])
            assert got.columns == ["k", "t", "n", "asof", "v"]
            assert sorted(map(tuple, got.collect()), key=str) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert asof_join(a.limit(0), b, "k", "t", "rt", ["v"]).count() == 0
    assert asof_join(a, b.limit(0), "k", "t", "rt", ["v"]).filter("asof IS NOT NULL").count() == 0
