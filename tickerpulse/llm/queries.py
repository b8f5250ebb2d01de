"""One thin query per corpus operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    op1_topk_search,
    op2_simhash,
    op3_fingerprints,
    op4_quality,
    op5_mixing,
    op6_token_counts,
    op7_toxicity,
    op8_packing,
    op9_pii,
    op10_url_filter,
    op11_minhash,
    op12_spelling,
)
from . import op13_vector_codes as vector_codes
from .common import table


def op1_topk_search_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents by BM25 for the text of every document whose id is divisible by 20 (query_id), out of all documents."""
    docs = table(spark, sf_dir, "documents")
    return op1_topk_search.search(docs, docs.filter("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id"), 10, query_id="query_id")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose SimHash fingerprints (3-word shingles) reach each other in steps of at most 2 bits."""
    return op2_simhash.near_dedup(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op3_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text; for ids divisible by 20, how many lie within 15 of 256 bits."""
    return op3_fingerprints.report(table(spark, sf_dir, "documents"), lambda i: i % 20 == 0, radius=15)


def op4_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior quality of every document, its source as host, source and language as path."""
    return op4_quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed so that sources, weighing 3, 1, 2 in turn, share 150 % of all words; none above twice its own."""
    return op5_mixing.taken_rows(op5_mixing.mix(table(spark, sf_dir, "documents"), (3.0, 1.0, 2.0), 1.5, 2.0))


def op6_separator_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, found by scanning the flat token files made of all documents."""
    return op6_token_counts.count_documents(spark, table(spark, sf_dir, "documents"))


def op7_toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, from a model fitted on the toxic labels."""
    docs = table(spark, sf_dir, "documents")
    model = op7_toxicity.train(docs, table(spark, sf_dir, "labels"))
    return op7_toxicity.score(docs, model).select("doc_id", "severity", "p_toxic", "grade", "toxic")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in as few sequences of at most 2048 as the configuration LP finds."""
    return op8_packing.best_fit(table(spark, sf_dir, "documents"), 2048, 0)


def op9_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: fixed patterns and what the character model adds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op9_pii.report(op9_pii.find(docs, op9_pii.train(docs)))


#: fixed values: the rules that the query is asked for
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op10_url_filter_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: the longest fitting rule's, else the boosted trees'."""
    return op10_url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "p_block")


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose sets of 2-word shingles have a Jaccard similarity of 0.8 or more."""
    return op11_minhash.near_dedup(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of all documents with its near words, its form and the root that forms lead to."""
    return op12_spelling.group(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four one-byte codes of every embedding, from codebooks of 256 entries refined in 4 rounds."""
    return vector_codes.report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_topk_search_bm25, op2_simhash_near_dedup, op3_simhash_fingerprints, op4_quality_bayes, op5_entropy_mixing,
    op6_separator_token_counts, op7_toxicity_severity, op8_best_fit_packing, op9_pii_spans, op10_url_filter_trees,
    op11_minhash_near_dedup, op12_spelling_variants, op13_vector_codes,
)}

#: None of the ten fits SQL: fingerprints by XXH64, trained models, a tokenizer, exact pruning. See tests/llm.
ORACLE: dict[str, str] = {}
