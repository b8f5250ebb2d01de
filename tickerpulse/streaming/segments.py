"""Append-only stream outputs, compacted while they grow.

Micro-batches write ``<table>/batch=<n>/<day>=<date>/...``. Before batch ``n``
runs, every batch below it is final, and the last ``FAN ** l`` of them become
one folder ``<table>/segment=<first>-<end>`` for the highest level ``l`` (up to
``LEVELS``) at which ``n`` is a multiple: ten batches become a segment, ten of
those the next. A table of ``n`` batches is thus read from at most
``(FAN - 1) * LEVELS + n / FAN ** LEVELS`` folders, a row is rewritten at most
``LEVELS`` times, and within a segment's day files are rolled at about
``roll_bytes``.

A folder counts once Spark has written its ``_SUCCESS``; until then readers
take what a segment is made of, so a job killed while compacting leaves nothing
missing and nothing twice, and its next run writes the segment anew. What a
segment replaces stays until the next compaction, for readers that listed it
before. No reader has to know of any of this: ``read_segments`` lists and reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..constants import ROLL_BYTES
from .days import _path, folders, path_exists, remove

FAN = 10
LEVELS = 3


def _folders(spark: SparkSession, table: str) -> dict[str, tuple[int, int]]:
    """Folder -> the batches it holds, (first, end) with ``end`` excluded."""
    found = {f"segment={n}": tuple(map(int, n.split("-"))) for n in folders(spark, table, "segment=")}
    return found | {f"batch={n}": (int(n), int(n) + 1) for n in folders(spark, table, "batch=")}


def _current(spark: SparkSession, table: str) -> dict[str, tuple[int, int]]:
    """The folders that make up the table: of those written to the end, the widest."""
    parts = {n: r for n, r in _folders(spark, table).items() if path_exists(spark, f"{table}/{n}/_SUCCESS")}
    return {n: r for n, r in parts.items() if not any(_inside(r, o) for o in parts.values())}


def _inside(part: tuple[int, int], other: tuple[int, int]) -> bool:
    return part != other and other[0] <= part[0] and part[1] <= other[1]


def _read(spark: SparkSession, table: str, names: list[str], schema: StructType) -> DataFrame:
    """The rows of some of a table's folders; the folders' own days become a column again."""
    out = None
    for name in sorted(names):
        path, fs = _path(spark, f"{table}/{name}")
        if not any(s.isDirectory() for s in fs.listStatus(path)):
            continue  # a batch without rows
        df = spark.read.schema(schema).option("basePath", f"{table}/{name}").parquet(f"{table}/{name}").select(*schema.names)
        out = df if out is None else out.unionByName(df)
    return spark.createDataFrame([], schema) if out is None else out


def read_segments(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """All rows that the batches wrote, each once."""
    return _read(spark, table, list(_current(spark, table)), schema)


def compact(spark: SparkSession, table: str, schema: StructType, day: str, batch_id: int, roll_bytes: int = ROLL_BYTES) -> str | None:
    """To be called at the start of batch ``batch_id``: writes the segment that is due, if one is, and
    returns its folder. Removes what the segments of earlier calls replaced."""
    level = max((l for l in range(1, LEVELS + 1) if batch_id and batch_id % FAN ** l == 0), default=0)
    if not level:
        return None
    first = batch_id - FAN ** level
    target, now = f"segment={first}-{batch_id}", _current(spark, table)
    earlier = [r for n, r in now.items() if n != target]
    for name, part in _folders(spark, table).items():
        if any(_inside(part, e) for e in earlier):
            remove(spark, f"{table}/{name}")
    if target in now:
        return f"{table}/{target}"  # written by a run of this batch that failed later
    parts = [n for n, part in now.items() if _inside(part, (first, batch_id))]
    rows = _read(spark, table, parts, schema)
    count = rows.count()  # out of the files' footers
    size = sum(fs.getContentSummary(p).getLength() for p, fs in (_path(spark, f"{table}/{n}") for n in parts))
    per_file = max(1, int(roll_bytes * count / size)) if size else 0  # 0: no limit
    (rows.hint("rebalance", day).write.mode("overwrite").option("maxRecordsPerFile", per_file)
     .partitionBy(day).parquet(f"{table}/{target}"))
    return f"{table}/{target}"

