"""A table kept by day that micro-batches replace day by day.

Layout: ``<table>/<day>=<date>/batch=<n>``. A batch writes a whole new version
of each day that it touches and leaves the others alone; readers take the
newest version of each day. A version is made from the newest one of an
*earlier* batch, so a batch that runs again after a failure writes the same
rows into its own folder; what is older than that base is removed. A day thus
holds two versions at most, and a batch opens the folders of its own days
alone, however long the history is.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The folder name that Spark gives to NULL.
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of the file system that Spark itself uses for it."""
    p, fs = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of the folders right below ``path``."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n[len(prefix):] for n in names if n.startswith(prefix))


def day_name(day: dt.date | None) -> str:
    return NULL_DAY if day is None else day.isoformat()


def days_of(rows: DataFrame, day: str) -> list[dt.date | None]:
    """The distinct days of a micro-batch, on the driver: as many as the batch touches."""
    return [r[0] for r in rows.select(day).distinct().collect()]


def _versions(spark: SparkSession, table: str, day: str, name: str) -> list[int]:
    return sorted(int(n) for n in folders(spark, f"{table}/{day}={name}", "batch="))


def read_days(spark: SparkSession, table: str, schema: StructType, day: str, names: list[str] | None = None,
              before: int | None = None, every: bool = False) -> DataFrame:
    """The newest version of each day (or of the named days), of batches before ``before`` if given;
    ``every`` reads all folders of a day, for tables that batches add to."""
    found = []
    for name in folders(spark, table, f"{day}=") if names is None else names:
        numbers = [n for n in _versions(spark, table, day, name) if before is None or n < before]
        found += [f"{table}/{day}={name}/batch={n}" for n in (numbers if every else numbers[-1:])]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", table).parquet(*found).select(*schema.names)


def write_days(rows: DataFrame, table: str, day: str, batch_id: int) -> None:
    """``rows`` under their days as this batch's folders; a repeated batch replaces its own folders alone."""
    (rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day, "batch").parquet(table))


def replace_days(rows: DataFrame, table: str, day: str, batch_id: int, merged: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Write ``merged(earlier rows of the days, rows)`` as the new version of every day in
    ``rows`` (stored, so that it may be read twice) and return the earlier rows."""
    spark, names = rows.sparkSession, [day_name(d) for d in days_of(rows, day)]
    base = read_days(spark, table, rows.schema, day, names, before=batch_id)
    write_days(merged(base, rows), table, day, batch_id)
    for name in names:
        for n in [n for n in _versions(spark, table, day, name) if n < batch_id][:-1]:
            remove(spark, f"{table}/{day}={name}/batch={n}")
    return base
