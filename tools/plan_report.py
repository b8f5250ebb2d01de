"""Summarise the final (adaptive) physical plan of every registered query.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Each query is executed through the ``noop`` sink, then its final plan is
scanned for shuffles, join strategies, top-k limits, generators, scans and
Python evaluation nodes.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SIDE_EFFECT = {"publish_all", "read_envelopes", "posts_published", "published_roundtrip",
               "sql_over_published", "write_bars_json", "write_rolled", "read_bars"}


def summarise(plan: str) -> dict:
    # an adaptive plan prints the final plan first, then the initial one
    plan = plan.split("== Initial Plan ==")[0]

    def n(pat):
        return len(re.findall(pat, plan))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    return {
        "shuffles": n(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition"),
        "broadcast": n(r"BroadcastExchange"),
        "bhj": n(r"BroadcastHashJoin"),
        "smj": n(r"SortMergeJoin"),
        "shj": n(r"ShuffledHashJoin"),
        "wgl": n(r"WindowGroupLimit"),
        "take": n(r"TakeOrderedAndProject"),
        "expand": n(r"Expand \["),
        "generate": n(r"Generate "),
        "scans": len(scans),
        "max_cols": max((len(s.split(",")) for s in scans), default=0),
        "sorts": n(r"\bSort \["),
        "sort_agg": n(r"SortAggregate"),
        "python": n(r"BatchEvalPython|ArrowEvalPython"),
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tickerpulse.session import build_session
    from tickerpulse.plans import catalog
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    rows = []
    for name, fn in sorted(catalog.queries().items()):
        if name.startswith("stream_") or name in SIDE_EFFECT:
            continue
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        rows.append((name, summarise(df._jdf.queryExecution().executedPlan().toString())))
    cols = ["shuffles", "broadcast", "bhj", "smj", "shj", "wgl", "take", "expand", "generate",
            "scans", "max_cols", "sorts", "sort_agg", "python"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, s in rows:
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
