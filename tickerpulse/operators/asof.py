"""As-of join: each row meets the last earlier row of the same key.

Rows of both sides are laid out by ranges of (key, time), staged, and the last
value is carried forward within each range; a key that holds most rows lies in
many ranges. What a range has carried at its end goes on into the next one:
one row per range, worked out on the driver and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: list[str]) -> DataFrame:
    """``left`` with the ``values`` of the last row of ``right`` with the same ``key``
    whose ``right_time`` is not after ``left_time``, and ``asof``, that row's time.

    Rows without a key, a time or an earlier row get NULLs. ``right`` has one
    row per (key, time); rows of it without a key or a time match nothing.
    """
    value = F.struct(F.col(right_time).alias("asof"), *values)
    bars = right.filter(F.col(key).isNotNull() & F.col(right_time).isNotNull()) \
        .select(F.col(key).alias("_k"), F.col(right_time).alias("_t"), F.lit(0).alias("_side"), value.alias("_v"))
    usable = F.col(key).isNotNull() & F.col(left_time).isNotNull()
    rows = left.filter(usable).select(F.col(key).alias("_k"), F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"))
    both = bars.unionByName(rows, allowMissingColumns=True)
    # ties of key and time are spread by a hash, so that not even they need one range
    laid = staged(both.repartitionByRange("_k", "_t", "_side", F.xxhash64(F.to_json("_row"))).withColumn("_part", F.spark_partition_id()), "asof")
    ends = laid.groupBy("_part").agg(F.min("_k").alias("first"), F.max("_k").alias("last"),
                                     F.max(F.when(F.col("_side") == 0, F.struct("_k", "_t"))).alias("at"))
    last_bars = staged(ends, "asof-ends")
    carried = last_bars.join(laid.filter("_side = 0").select(F.col("_part").alias("p"), F.struct("_k", "_t").alias("a"), "_v"),
                             (F.col("_part") == F.col("p")) & (F.col("at") == F.col("a")), "left").select("_part", "first", "last", "at", "_v")
    held, out = None, []
    for r in sorted(carried.collect(), key=lambda r: r["_part"]):  # a row for each range
        out.append((r["_part"], r["first"], held[1] if held and held[0] == r["first"] else None))
        if r["at"] is not None and r["at"]["_k"] == r["last"]:
            held = (r["last"], r["_v"])
        elif not held or held[0] != r["last"]:
            held = None
    spark = left.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in laid.schema}
    carry = F.broadcast(spark.createDataFrame(out, f"_part int, _first {kinds['_k']}, _carried {kinds['_v']}"))
    own = F.last("_v", ignorenulls=True).over(Window.partitionBy("_part", "_k").orderBy("_t", "_side")
                                              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = laid.withColumn("_own", own).filter("_side = 1").join(carry, "_part") \
        .withColumn("_v", F.coalesce("_own", F.when(F.col("_k") == F.col("_first"), F.col("_carried"))))
    nulls = left.filter(~usable).select("*", *[F.lit(None).cast(right.schema[c].dataType).alias(n)
                                               for n, c in [("asof", right_time), *((v, v) for v in values)]])
    return met.select("_row.*", "_v.*").unionByName(nulls)
