"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerpulse.session import scratch_path

#: A word is a maximal run of anything but space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"

#: Seed of the 64-bit hashes that order or split rows.
SPLIT_SEED = "tickerpulse"

_ALNUM = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words without punctuation: runs of ASCII letters, ASCII digits and non-ASCII characters."""
    return (text or "").lower().encode("utf-8", "replace").translate(_ALNUM).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage: what follows reads files that survive lost executors,
    and each later use reads them again instead of computing anew.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove a table made by ``stored`` that nothing will read again, so that rounds don't pile up."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of texts that a Python worker holds at once.
TEXT_ROWS = 1000


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, after bounding the Arrow batches of its session: a worker that is
    handed whole texts holds a few MB of them instead of 10,000 rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= TEXT_ROWS:
        df.sparkSession.conf.set(key, str(TEXT_ROWS))
    return df


def words_count(text):
    """Column: number of words of a text, 0 for NULL and for no words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stable_hash(*cols):
    """Column: a 64-bit hash that depends on the values alone."""
    return F.xxhash64(F.lit(SPLIT_SEED), *cols)


def row_key(columns: list[str]):
    """Column: a key of 128 bits that rows share only if they are equal in all ``columns``, NULLs included."""
    flags = F.concat(F.lit(""), *[F.isnull(F.col(f"`{c}`")).cast("int").cast("string") for c in sorted(columns)])
    values = [F.col(f"`{c}`") for c in sorted(columns)]
    # xxhash64 skips NULLs: the flags say where they are
    return F.concat_ws("-", *[F.hex(F.xxhash64(F.lit(f"{SPLIT_SEED} {i}"), flags, *values)) for i in (1, 2)])


def free_name(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column of ``taken`` is called so."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name
