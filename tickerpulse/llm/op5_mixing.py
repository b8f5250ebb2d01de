"""Mixing sources to target weights by entropy balancing.

Among all document rates ``r`` that give every source its target number of
words, entropy balancing takes those closest to the prior rates ``q`` in
relative entropy, a document counting by its words. The optimum is an
exponential tilt, ``r = min(cap, q * exp(lambda_source))``, and the
multipliers solve a convex dual, one term per source and coupled only by the
data: Newton steps need the words and their curvature at the present rates,
two sums per source. Spark computes them over a table pre-aggregated to
(source, prior), so no step touches documents again and nothing per source
is collected.

Rates become whole copies, ``floor(r)`` or ``ceil(r)`` of a document each:
within a source, blocks of at most ``BLOCK`` different rows are walked from
the largest document to the smallest, each taking the rounding that brings the words
taken so far nearest to what the rates ask, so what remains at the end of a
block is about half of its smallest document. Blocks are cut by a hash of the
row: a source of any size is spread over many tasks, and reruns agree.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, row_key, stable_hash, stored, words_count

#: Different rows rounded together.
BLOCK = 8192


def numbered(df: DataFrame, *order) -> DataFrame:
    """``df`` with ``number``, 0 and up in the given order, without one task that holds all rows.

    Rows are range-partitioned and numbered per partition; one count per
    partition is all that reaches the driver. Ties get some fixed order.
    """
    laid = stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    counts = sorted(laid.groupBy("_part").count().collect())
    first, at = [], 0
    for part, n in counts:
        first.append((part, at))
        at += n
    offsets = F.broadcast(df.sparkSession.createDataFrame(first, "_part int, _first long"))  # a row per partition
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (laid.withColumn("_own", own).join(offsets, "_part")
            .withColumn("number", F.col("_first") + F.col("_own") - 1).drop("_part", "_own", "_first"))


def capped_shares(sources: DataFrame, total: float, cap: float) -> DataFrame:
    """``sources`` (source, words, weight) with ``target``: ``total`` shared by weight, no
    target above ``cap`` times the source's words, what that leaves reshared by weight.

    Each round is one aggregate of two sums; the sources that a share fills
    stay filled as the share grows, so one number describes a round.
    """
    most = F.col("words") * F.lit(float(cap))
    share = 0.0
    while True:
        full = most <= F.col("weight") * F.lit(share)
        row = sources.agg(F.sum(F.when(full, most).otherwise(0.0)).alias("taken"),
                          F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if not row["open"]:
            break
        now = max(share, (total - row["taken"]) / row["open"])
        if now <= share * (1 + 1e-15):
            break
        share = now
    return sources.withColumn("target", F.least(most, F.col("weight") * F.lit(share)))


def newton_multipliers(cells: DataFrame, targets: DataFrame, cap: float, *, tolerance: float = 1e-9,
                       max_steps: int = 60) -> DataFrame:
    """(source, target, lam) that solve the dual; ``cells`` is (source, prior, words), ``targets`` (source, target).

    A step that leaves the bracket of the root found so far is replaced by its
    middle. Stops when no source is off its target by more than ``tolerance``
    of it; a target of 0 or beyond cap times the words is approached as near
    as the bracket allows.
    """
    low = cells.groupBy(F.col("source").alias("_s")).agg(F.min("prior").alias("least"))
    state = stored(targets.select("source", "target").join(low, F.col("source").eqNullSafe(F.col("_s")))
                   .select("source", "target", F.lit(0.0).alias("lam"), F.lit(-40.0).alias("lo"),
                           F.log(F.lit(float(cap)) / F.col("least")).alias("hi"))  # beyond it every rate is at the cap
                   .withColumn("lam", F.least("lam", "hi")), "mixing-lambda")
    tilted = F.col("prior") * F.exp("lam")
    words = F.col("words") * F.least(F.lit(float(cap)), tilted)
    for _ in range(max_steps):
        sums = (cells.join(state.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
                .groupBy("_s", "target", "lam", "lo", "hi")
                .agg(F.sum(words).alias("now"),
                     F.sum(F.when(tilted <= cap * (1 + 1e-12), words).otherwise(0.0)).alias("slope"))
                .withColumn("off", F.col("now") - F.col("target"))
                .withColumn("lo", F.when(F.col("off") < 0, F.col("lam")).otherwise(F.col("lo")))
                .withColumn("hi", F.when(F.col("off") > 0, F.col("lam")).otherwise(F.col("hi"))))
        step = F.col("lam") - F.col("off") / F.nullif("slope", F.lit(0.0))
        inside = F.col("slope").isNotNull() & (step >= F.col("lo")) & (step <= F.col("hi"))
        moved = stored(sums.select(
            F.col("_s").alias("source"), "target", "lo", "hi",
            (F.abs("off") <= tolerance * F.greatest(F.col("target"), F.lit(1.0))).alias("done"),
            F.col("lam").alias("was"),
            F.when(inside, step).otherwise((F.col("lo") + F.col("hi")) / 2).alias("lam")), "mixing-lambda")
        state = moved.select("source", "target", F.when(F.col("done"), F.col("was")).otherwise(F.col("lam")).alias("lam"), "lo", "hi")
        if not moved.filter(~F.col("done") & (F.abs(F.col("lam") - F.col("was")) > 1e-14)).limit(1).count():
            break
    return state.select("source", "target", "lam")


def _round_block(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies of each row of one block, from the largest size down, errors carried on."""
    rows = rows.sort_values(["size", "id", "row_key"], ascending=[False, True, True], na_position="last", kind="stable")
    rate, size, same = rows["rate"].to_numpy(float), rows["size"].to_numpy(float), rows["same"].to_numpy()
    copies, carry = np.empty(len(rows), np.int64), 0.0
    for i, (r, s, m) in enumerate(zip(rate.tolist(), size.tolist(), same.tolist())):
        low, high = int(np.floor(r + 1e-9)) * m, int(np.ceil(r - 1e-9)) * m
        if s <= 0:
            copies[i] = min(high, max(low, int(r * m + 0.5)))
            continue
        want = r * s * m + carry
        c = copies[i] = min(high, max(low, int(np.floor(want / s + 0.5))))
        carry = want - c * s
    return rows.assign(copies=copies)[["row_key", "id", "source", "size", "same", "source_size", "target", "rate", "copies"]]


def mix(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0, *,
        id_col: str = "doc_id", text: str = "text", source: str = "source", prior: float = 1.0) -> DataFrame:
    """One row per different row of ``docs``: row_key (hash of all its columns), id,
    source, size in words, same (how often it occurs), source_size, target, rate, copies (of all its occurrences).

    Sources by code point, NULL last, weigh ``weights`` in turn and share
    ``share`` times all words; no source exceeds ``cap`` times its own. A text
    that is NULL or empty has size 0 and does not count for any target; rows
    that repeat share their source's rate and are rounded together. Empty
    tables give an empty result. Columns named like the result's are only hashed.
    """
    units = stored(docs.select(row_key(docs.columns).alias("row_key"), F.col(id_col).alias("id"), F.col(source).alias("source"),
                               words_count(F.col(text)).alias("size"))
                   .groupBy("row_key", "id", "source", "size").agg(F.count("*").alias("same")), "mixing-units")
    cells = stored(units.groupBy("source").agg(F.sum(F.col("size") * F.col("same")).alias("words"), F.count("*").alias("units"))
                   .withColumn("prior", F.lit(float(prior))), "mixing-cells")
    total = cells.agg(F.sum("words")).first()[0] or 0
    ranked = numbered(cells, F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    shared = stored(capped_shares(ranked.withColumn("weight", weight), share * total, cap), "mixing-shares")
    solved = newton_multipliers(cells, shared, cap)
    plan = stored(solved.join(cells.withColumnRenamed("source", "_c"), F.col("source").eqNullSafe(F.col("_c")))
                  .select(F.col("source").alias("_s"), "target", F.col("words").alias("source_size"), "units",
                          F.when(F.col("target") > 0, F.least(F.lit(float(cap)), F.lit(float(prior)) * F.exp("lam")))
                          .otherwise(F.when(F.col("words") > 0, 0.0).otherwise(float(prior))).alias("rate")), "mixing-plan")
    blocks = F.ceil(F.col("units") / F.lit(BLOCK)).cast("long")
    given = (units.join(plan, F.col("source").eqNullSafe(F.col("_s")))
             .select("row_key", "id", "source", "size", "same", "source_size", "target", "rate",
                     F.pmod(stable_hash("row_key", "size"), blocks).alias("block")))
    kind = dict(units.dtypes)
    return given.groupBy("source", "block").applyInPandas(
        _round_block, f"row_key string, id {kind['id']}, source {kind['source']}, size long, same long, source_size long, target double, rate double, copies long")


def taken_rows(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document row: id, size, source_size, target, copies and ``taken`` (words, repeats counted)."""
    each = mixed.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "same")).alias("k"))
    copies = F.floor(F.col("copies") / F.col("same")) + F.when(F.col("k") <= F.col("copies") % F.col("same"), 1).otherwise(0)
    return (each.withColumn("copies", copies)
            .select(F.col("id").alias(id_col), "size", "source_size", "target", "rate", F.col("copies").cast("long"),
                    (F.col("copies") * F.col("size")).cast("long").alias("taken")))


def apply_copies(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``docs`` with each row as often as ``mixed`` says; rows of no copies go.

    ``mixed`` counts the copies of all occurrences of a row, so a row that
    repeats is first brought down to one, task by task, and then repeated.
    Columns of any name are kept as they are.
    """
    key, n, i = (free_name(x, docs.columns) for x in ("_key", "_copies", "_copy"))
    keyed = docs.withColumn(key, row_key(docs.columns))
    plan = mixed.filter("copies > 0").select(F.col("row_key").alias(key), F.col("copies").alias(n), "same")
    # the plan grows with the documents, so it is never broadcast; both joins share one shuffle of the texts
    once = keyed.join(plan.filter("same = 1").drop("same").hint("merge"), key)
    more = keyed.join(plan.filter("same > 1").drop("same").hint("merge"), key).dropDuplicates([key])
    return (once.unionByName(more).withColumn(i, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))).select(*[f"`{c}`" for c in docs.columns]))
