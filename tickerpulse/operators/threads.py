"""Reply threads: the first post and the depth of every post, by pointer jumping.

A post names the post that it answers. Each round every open post follows its
pointer's pointer, so a pointer spans twice as many posts as before and a
thread of n posts takes about log2(n) rounds, each one equi-join of two stored
tables (a post that very many answer is split by adaptive execution).

* A post that answers nothing, or a post that is not in the table, is the root
  of its thread, at depth 0.
* Posts on a cycle of answers, and posts that lead into one, have no root: NULL
  root and depth.
* Of repeated ids the smallest answered id counts. A post without an id takes
  the thread of the post it answers, one deeper; nothing can answer it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .context import conversation_context
from .skew import left_join_skip_nulls


def thread_roots(links: DataFrame) -> DataFrame:
    """(id, root, depth) of every distinct non-NULL id of ``links`` (id, parent)."""
    ids = staged(links.filter("id IS NOT NULL").groupBy("id").agg(F.min("parent").alias("parent")), "thread-ids")
    known = ids.select(F.col("id").alias("of"))
    with_parent = staged(ids.join(known, F.col("parent") == F.col("of"), "left").select("id", F.col("of").alias("up")), "thread-parents")
    # a pointer is open (up) or has arrived (root); hops is the distance to either
    state = staged(with_parent.select("id", "up", F.when(F.col("up").isNull(), F.col("id")).alias("root"),
                                      F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("hops")), "thread-state")
    open_ = state.filter("up IS NOT NULL").count()
    while open_:
        target = state.select(F.col("id").alias("of"), F.col("up").alias("up2"), F.col("root").alias("root2"), F.col("hops").alias("hops2"))
        moved = (state.filter("up IS NOT NULL").join(target, F.col("up") == F.col("of"))
                 .select("id", F.col("up2").alias("up"), F.col("root2").alias("root"), (F.col("hops") + F.col("hops2")).alias("hops")))
        state = staged(state.filter("up IS NULL").unionByName(moved), "thread-state")
        before, open_ = open_, state.filter("up IS NOT NULL").count()
        if open_ == before:  # no post is so deep, hence none is deeper: what is open goes round a cycle
            break
    return state.select("id", "root", F.when(F.col("up").isNull(), F.col("hops")).alias("depth"))


def with_threads(posts: DataFrame, id_col: str = "id", parent_col: str = "replied_to") -> DataFrame:
    """``posts`` with ``root`` and ``depth``."""
    links = posts.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent"))
    roots = staged(thread_roots(links), "threads")
    named = left_join_skip_nulls(posts.filter(F.col(id_col).isNotNull()), roots.withColumnRenamed("id", id_col), [id_col])
    above = roots.select(F.col("id").alias(parent_col), "root", (F.col("depth") + 1).alias("depth"))
    nameless = left_join_skip_nulls(posts.filter(F.col(id_col).isNull()), above, [parent_col]) \
        .withColumn("depth", F.when(F.col(parent_col).isNull(), 0).otherwise(F.col("depth")))
    return named.select(*posts.columns, "root", "depth").unionByName(nameless.select(*posts.columns, "root", "depth"))


def thread_context(posts: DataFrame, universe, id_col: str = "id", parent_col: str = "replied_to", text_col: str = "text") -> DataFrame:
    """Add ``root``, ``depth`` and ``tickers``, the symbols of a post's whole thread, whatever its conversation id says."""
    return conversation_context(with_threads(posts, id_col, parent_col), universe, "root", text_col)
