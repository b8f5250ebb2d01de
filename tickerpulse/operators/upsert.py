"""One row per post, whichever collectors and runs met it.

Both collectors may deliver the same post, at different times and with other
metrics. The row seen last wins, and the collectors that saw the post are
listed. A stored table takes new rows day by day: a post's day follows from its
creation, so both rows of a post lie in one day and no other day is opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..streaming.days import replace_days


def latest_posts(posts: DataFrame, seen: str = "seen_at", id_col: str = "id") -> DataFrame:
    """One row per id: the one of the greatest ``seen`` (NULL first; ties: the greatest row in
    column order, ``sources`` of all). ``sources``, an array, must be a column. Rows without an id are posts of their own.

    One hash partition per id after a partial aggregate on each task, so copies of one post meet as one row a task.
    """
    rest = [c for c in posts.columns if c not in (id_col, "sources")]
    order = F.struct(seen, *[c for c in rest if c != seen])
    known = posts.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.max(order).alias("_last"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("sources")))).alias("sources"))  # as many as collectors
    known = known.select(*[F.col(c) if c in (id_col, "sources") else F.col("_last")[c].alias(c) for c in posts.columns])
    return known.unionByName(posts.where(F.col(id_col).isNull()))


def upsert_posts(rows: DataFrame, table: str, batch_id: int, day: str = "date", seen: str = "seen_at") -> None:
    """Merge ``rows`` (stored) into the table kept by ``day``. Rows given again change nothing, whether under
    the same ``batch_id`` or a later one; rows without an id are added by every batch."""
    replace_days(rows, table, day, batch_id, lambda base, new: latest_posts(base.unionByName(new), seen))
