"""Token counts of documents in flat, unindexed token files.

A flat file is a run of fixed-width little-endian ids in which one id ends
each document; nothing says where documents begin. Files are scanned in
blocks of ``block_tokens`` by many tasks, wherever they are cut: each block
is searched by one vectorised comparison for the end id and yields its
complete documents (between two ends inside it), the length of its head (up
to its first end) and of its tail (after its last end). A prefix scan over
the block summaries of a file, one small row each, gives every block the
number of documents that ended before it and the tokens carried into its
head across any number of blocks without an end. A file may hold a document
of any length.

``write_flat`` makes such files from a table: each task encodes its rows and
writes one file to the shared folder through pyarrow's file systems, under a
name of its own, so a task that runs twice leaves a file that nobody lists.
The order of the documents is kept beside the files to tell which is which.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerpulse.session import scratch_path

from .common import stored, text_batches
from .tokens import RANKS, VOCABULARY, encode_ordinary

END = 50256
BLOCK_TOKENS = 1 << 20


def _open(path: str):
    """(file system, path) of a shared folder or file; a path without a scheme is local."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_flat(docs: DataFrame, folder: str, *, id_col: str = "doc_id", text: str = "text", end: int = END, dtype: str = "<u2",
               vocabulary: str = VOCABULARY, ranks: str | None = RANKS) -> DataFrame:
    """Write the ids of ``docs`` and an end id after each to flat files; (file, tokens, ordinal, id) of each document, stored.

    ``tokens`` is the size of the file. NULL and empty texts are an end id alone.
    The vocabulary must fit ``dtype``. A text that spells a special token is encoded
    as ordinary text, no token of it is lost; an end id within a text raises.
    """
    system, base = _open(folder)
    system.create_dir(base, recursive=True)
    kind = dict(docs.dtypes)[id_col]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = f"tokens-{uuid.uuid4().hex}.bin"
        target, place = _open(folder)
        out, size, ids = None, 0, []
        for b in batches:
            for i, t in zip(b["id"].tolist(), b["t"]):
                if out is None:
                    out = target.open_output_stream(f"{place}/{name}")
                got = encode_ordinary(t or "", vocabulary, ranks)
                if (got == end).any():
                    raise ValueError(f"the vocabulary gives the end id {end} within a text")
                data = np.append(got, end).astype(dtype)
                out.write(data.tobytes())
                size += len(data)
                ids.append(i)
        if out is not None:
            out.close()
            yield pd.DataFrame({"file": f"{folder}/{name}", "tokens": size, "ordinal": np.arange(len(ids)), "id": pd.array(ids, dtype=object)})
    rows = text_batches(docs).select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    return stored(rows.mapInPandas(write, f"file string, tokens long, ordinal long, id {kind}"), "flat-order")


def scan(files: DataFrame, end: int = END, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, ordinal, start, tokens) of every document of ``files`` (file, tokens).

    ``tokens`` counts without the end id and ``start`` in tokens from the start of
    the file. Ids after the last end are a document of their own. Files listed
    twice count once; empty files have no documents; an empty list gives an empty table.
    """
    width = np.dtype(dtype).itemsize
    blocks = (files.select("file", "tokens").distinct().filter("tokens > 0")
              .select("file", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("tokens") / block_tokens) - 1)).alias("block")))
    blocks = blocks.repartition(F.col("file"), F.col("block"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for file, tokens, block in zip(b["file"], b["tokens"].tolist(), b["block"].tolist()):
                system, place = _open(file)
                begin = block * block_tokens
                n = min(block_tokens, tokens - begin)
                with system.open_input_file(place) as f:
                    ids = np.frombuffer(f.read_at(n * width, begin * width), dtype)
                if len(ids) != n:
                    raise OSError(f"{file} is shorter than listed")
                ends = np.flatnonzero(ids == end)
                head, tail = (int(ends[0]), n - 1 - int(ends[-1])) if len(ends) else (n, n)
                out.append((file, block, begin, len(ends), head, tail, begin + n == tokens, (np.diff(ends) - 1).tolist()))
            yield pd.DataFrame(out, columns=["file", "block", "begin", "ends", "head", "tail", "last", "inner"])
    found = stored(blocks.mapInPandas(search, "file string, block long, begin long, ends long, head long, tail long, last boolean, inner array<long>"), "flat-blocks")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # what is carried in: the tail of the last block with an end, and all blocks without one since then
    whole = F.coalesce(F.sum(F.when(F.col("ends") == 0, F.col("tail")).otherwise(0)).over(before), F.lit(0))
    scanned = (found.drop("inner").withColumn("first", F.coalesce(F.sum("ends").over(before), F.lit(0))).withColumn("whole", whole)
               .withColumn("mark", F.last(F.when(F.col("ends") > 0, F.struct("tail", "whole")), ignorenulls=True).over(before))
               .withColumn("carry", F.coalesce(F.col("mark.tail"), F.lit(0)) + F.col("whole") - F.coalesce(F.col("mark.whole"), F.lit(0)))
               .select("file", "block", "first", "carry"))
    stitched = found.join(scanned, ["file", "block"])
    head = F.array(F.struct(F.col("first").alias("ordinal"), (F.col("begin") - F.col("carry")).alias("start"), (F.col("carry") + F.col("head")).alias("tokens")))
    size = F.col("begin") + F.col("head") + 1  # of the first document that begins in the block
    heads = stitched.filter("ends > 0").select("file", F.explode(head).alias("d")).select("file", "d.*")
    inner = (stitched.filter("ends > 1").select("file", "first", size.alias("from"), "inner", F.posexplode("inner").alias("k", "tokens"))
             .select("file", (F.col("first") + 1 + F.col("k")).alias("ordinal"), "from", "k", "tokens", "first"))
    run = Window.partitionBy("file", "first").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    inner = inner.select("file", "ordinal", (F.col("from") + F.coalesce(F.sum(F.col("tokens") + 1).over(run), F.lit(0))).alias("start"), "tokens")
    open_end = (stitched.filter("last")
                .select("file", (F.col("first") + F.col("ends")).alias("ordinal"),
                        F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("carry") + F.col("tail")).alias("tokens"), "begin", "head", "tail", "ends", "carry")
                .filter("tokens > 0")
                .withColumn("start", F.when(F.col("ends") == 0, F.col("begin") - F.col("carry"))))
    # a block with ends: the open document begins after its last end, tokens before the block's own end
    ends_at = files.select(F.col("file").alias("_f"), F.col("tokens").alias("_n")).distinct()
    open_end = (open_end.join(ends_at, open_end["file"] == ends_at["_f"])
                .select("file", "ordinal", F.coalesce("start", F.col("_n") - F.col("tokens")).alias("start"), "tokens"))
    return heads.unionByName(inner).unionByName(open_end)


def count_documents(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Tokens of every document of ``docs``, found by scanning the flat files made of them: id, file_no, ordinal, start, tokens.

    Repeated rows stay repeated, NULL ids are kept, NULL and empty texts have 0 tokens.
    """
    order = write_flat(docs, scratch_path(spark, "flat-tokens"), id_col=id_col, text=text)
    found = scan(order.select("file", "tokens"), block_tokens=block_tokens)
    named = order.select(F.col("file").alias("_f"), F.col("ordinal").alias("_o"), F.col("id").alias(id_col))
    return (found.join(named, (F.col("file") == F.col("_f")) & (F.col("ordinal") == F.col("_o")))
            .select(id_col, F.element_at(F.split("file", "/"), -1).alias("file"), "ordinal", "start", found["tokens"]))
