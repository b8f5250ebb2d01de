"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists (name, function) pairs. Each function takes
``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as
Parquet to the shared checkpoint folder and rereads it as the next stage's
``docs``. A stage works on all its predecessor kept, its decisions take
effect, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerpulse.llm import op2_simhash, op5_mixing, op7_toxicity, op8_packing, op9_pii
from tickerpulse.llm.common import stored, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of any toxic grade is below one half stay, as they are.

    The model is fitted on the labelled rows of ``docs``; without labels of
    both kinds every document stays. NULL and empty texts stay.
    """
    model = op7_toxicity.train(docs, table(spark, sf_dir, "labels"))
    return op7_toxicity.score(docs, model).filter("NOT toxic").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the one with the smallest id.

    Classes are those of 3-word shingles and at most 2 bits; NULL, empty and
    blank texts are one class, linked like any other.
    """
    return op2_simhash.keep_one(docs, shingle=3, max_bits=2)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in every text gives way to its kind in brackets; ``n_chars`` follows. NULL texts stay NULL."""
    masked = op9_pii.mask(docs, op9_pii.train(docs))
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document occurs as often as the mix takes it (0 to 2 times), so that sources meet their targets.

    Sources by code point, NULL last, weigh 3, 1, 2 in turn and share 150 % of all words, none above twice its own.
    """
    return op5_mixing.apply_copies(docs, stored(op5_mixing.mix(docs, (3.0, 1.0, 2.0), 1.5, 2.0), "pipeline-copies"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of each occurrence: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return op8_packing.best_fit(docs, 2048, 0)


STAGES = [("toxicity", toxicity), ("simhash_near_dedup", near_dedup), ("pii", pii),
          ("mixing", mixing), ("best_fit_packing", packing)]

#: No stage can be written in SQL as a whole: trained models, fingerprints, a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; an empty table gives an empty result."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
