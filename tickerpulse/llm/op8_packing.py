"""Best-fit packing of tokenized documents into sequences.

Documents become pieces of at most ``capacity`` tokens, tokenized once and
stored without their ids (length and checksum remain). The histogram of piece
lengths, at most ``capacity`` numbers, goes to the driver; the plan made of it
(``packing_plan``: configuration LP by multiplicative weights with knapsack
pricing, rounded) says for each length which ranks go where. Ranks are given
by Spark: pieces are cut into blocks by a hash, numbered per (block, length),
and shifted by the counts of the blocks before, so one length shared by a
third of all pieces is numbered by many tasks. Placing a piece is then a
lookup in the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import packing_plan
from .common import stable_hash, stored, text_batches
from .tokens import RANKS, VOCABULARY, encode_all

CAPACITY = 2048
#: Pieces that are numbered together.
BLOCK = 4096


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, *, id_col: str = "doc_id", text: str = "text",
           vocabulary: str = VOCABULARY, ranks: str | None = RANKS) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document's ids and one ``end_id``.

    Only longer ones are cut: the last pieces hold ``capacity`` tokens, the first
    what is over. NULL and empty texts are one piece of one token. ``ids_crc32``
    is over the ids as little-endian unsigned 32-bit numbers.
    """
    @F.pandas_udf("array<struct<start:long,length:long,crc:long>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ts in batches:
            out = []
            for ids in encode_all((t or "" for t in ts), vocabulary, ranks):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                n = len(ids)
                edges = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                out.append([{"start": i, "length": j - i, "crc": zlib.crc32(ids[i:j].tobytes())} for i, j in zip(edges, edges[1:])])
            yield pd.Series(out)
    return (text_batches(docs).select(F.col(id_col).alias("id"), cut(F.col(text)).alias("cuts"))
            .select("id", F.posexplode("cuts").alias("piece", "c"))
            .select("id", "piece", "c.start", "c.length", F.col("c.crc").alias("ids_crc32")))


def _ranked(cut: DataFrame, total: int) -> DataFrame:
    """``cut`` (stored) with ``rank``: 0 and up within each length."""
    blocks = -(-total // BLOCK)
    cut = cut.withColumn("block", F.pmod(stable_hash("id", "piece", "length", "ids_crc32"), F.lit(blocks)))
    counts = stored(cut.groupBy("block", "length").agg(F.count("*").alias("n")), "packing-counts")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("block")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = stored(counts.select("block", "length", before.alias("before")), "packing-offsets")
    own = F.row_number().over(Window.partitionBy("block", "length").orderBy("id", "piece", "ids_crc32"))
    return (cut.join(offsets.hint("merge"), ["block", "length"])  # its partitions are the window's
            .withColumn("rank", F.col("before") + own - 1).drop("block", "before"))


def pack(cut: DataFrame, capacity: int = CAPACITY, rounds: int = 150, passes: int = 4) -> DataFrame:
    """``cut`` (as of ``pieces``, stored) with ``sequence_id`` and ``offset``.

    Repeated rows are places of their own; an empty table gives an empty one.
    """
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    runs, _ = packing_plan.plan(histogram, capacity, rounds, passes)
    by_length: dict[int, list[packing_plan.Run]] = {}
    for r in runs:
        by_length.setdefault(r.length, []).append(r)
    firsts = {k: [r.first for r in v] for k, v in by_length.items()}

    @F.pandas_udf("sequence_id long, offset long")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for lengths, ranks in batches:
            out = []
            for length, rank in zip(lengths.tolist(), ranks.tolist()):
                r = by_length[length][bisect_right(firsts[length], rank) - 1]
                copy, slot = divmod(rank - r.first, r.per)
                out.append((r.sequence + copy, r.offset + slot * length))
            yield pd.DataFrame(out, columns=["sequence_id", "offset"])
    return (_ranked(cut, max(1, sum(histogram.values())))
            .select("*", place("length", "rank").alias("at"))
            .select("id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset"))


def best_fit(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Extra columns of ``docs`` are not read.
    """
    cut = stored(pieces(docs, capacity, end_id, id_col=id_col, text=text), "packing-pieces")
    return pack(cut, capacity).withColumnRenamed("id", id_col)
