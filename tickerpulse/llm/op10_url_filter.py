"""URL filter: host and path rules, and gradient-boosted trees where no rule fits.

A rule ``host/path`` fits its host and all subdomains if the URL's path starts
with the rule's path; the longest fitting rule decides. URLs that a rule
decides are the labelled ones: on them boosted trees learn from lexical
features (lengths, depth, digit ratio, entropy of the characters, parameter
counts, labels of the host, and statistics of the host suffix and of the first
path segment: their smoothed share of blocked labelled URLs). The trees judge
the rest. Features are SQL expressions; the trees are Spark's own.

Bound of the training sample (documented parameter): at most ``per_class``
allowed and as many blocked URLs, those with the smallest hash; the suffix
and segment statistics are over all labelled rows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stable_hash, stored

PER_CLASS = 20_000
#: Labelled URLs that a suffix's share is shrunk by towards the overall share.
SHRINK = 20.0

FEATURES = ["url_chars", "host_chars", "path_chars", "query_chars", "depth", "digit_ratio", "entropy", "params",
            "labels", "hyphens", "longest_segment", "suffix_share", "suffix_known", "segment_share", "segment_known"]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url):
    """Two columns: host (A-Z lower-cased) and path; both empty for NULL or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.contains(url, F.lit("://")), F.substring_index(url, "://", 1)).otherwise(F.lit(None))
    after = F.coalesce(F.substring(url, F.length(rest) + 4, F.length(url)), F.lit(""))
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def rule_columns(host, path, rules: list[tuple[str, str]]):
    """Columns (rule, verdict) of the longest fitting rule, NULL where none fits; ``rules`` are (verdict, "host/path")."""
    rule = verdict = None
    for decides, text in sorted(rules, key=lambda r: -len(r[1])):
        at, _, rest = text.partition("/")
        at = at.translate(str.maketrans(_UPPER, _LOWER))
        fits = ((host == at) | F.endswith(host, F.lit(f".{at}"))) & F.startswith(path, F.lit(f"/{rest}"))
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, decides) if verdict is None else verdict.when(fits, decides)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def _lexical(pages: DataFrame) -> DataFrame:
    """``pages`` (url, host, path, ...) with the lexical features and the keys of the statistics."""
    url = F.coalesce("url", F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    segments = F.filter(F.split("path", "/"), lambda s: s != "")

    def share(c):  # occurrences of one character
        return (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n
    entropy = F.aggregate(F.array_distinct(F.filter(F.split(url, ""), lambda c: c != "")), F.lit(0.0), lambda a, c: a - share(c) * F.log(share(c)))
    return pages.select(
        "*", F.length(url).cast("double").alias("url_chars"), F.length("host").cast("double").alias("host_chars"),
        F.length("path").cast("double").alias("path_chars"), F.length(query).cast("double").alias("query_chars"),
        F.size(segments).cast("double").alias("depth"),
        (F.regexp_count(url, F.lit("[0-9]")) / n).alias("digit_ratio"), entropy.alias("entropy"),
        F.when(query != "", F.size(F.split(query, "&"))).otherwise(0).cast("double").alias("params"),
        F.when(F.col("host") != "", F.size(F.split("host", r"\."))).otherwise(0).cast("double").alias("labels"),
        F.regexp_count("host", F.lit("-")).cast("double").alias("hyphens"),
        F.coalesce(F.array_max(F.transform(segments, lambda s: F.length(s))), F.lit(0)).cast("double").alias("longest_segment"),
        F.substring_index("host", ".", -1).alias("suffix"), F.coalesce(F.get(segments, F.lit(0)), F.lit("")).alias("segment"))


def _statistics(labelled: DataFrame, key: str, overall: float) -> DataFrame:
    """(key, share, known): the blocked share of the labelled URLs of each value, shrunk to the overall share."""
    got = labelled.groupBy(key).agg(F.sum("label").alias("blocked"), F.count("*").alias("n"))
    return got.select(F.col(key).alias(f"_{key}"), ((F.col("blocked") + SHRINK * overall) / (F.col("n") + SHRINK)).alias(f"{key}_share"),
                      F.log1p("n").alias(f"{key}_known"))


def _with_statistics(rows: DataFrame, found: dict[str, DataFrame], overall: float) -> DataFrame:
    for key, stats in found.items():
        rows = (rows.join(stats, rows[key] == stats[f"_{key}"], "left").drop(f"_{key}")
                .withColumns({f"{key}_share": F.coalesce(f"{key}_share", F.lit(overall)), f"{key}_known": F.coalesce(f"{key}_known", F.lit(0.0))}))
    return rows


def judge(pages: DataFrame, rules: list[tuple[str, str]], *, id_col: str = "page_id", url: str = "url",
          per_class: int = PER_CLASS, trees: int = 15, depth: int = 4) -> DataFrame:
    """One row per page: id, host, path, rule (NULL where none fits), verdict, p_block (NULL where a rule decides).

    Without labelled URLs of both kinds the rest gets the only kind there is,
    or ``allow``. Repeated rows stay repeated; an empty table gives an empty one;
    other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(F.col(id_col).alias("id"), F.col(url).alias("url")).select("*", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    rows = stored(parsed.select("*", rule.alias("rule"), verdict.alias("verdict")), "urls")
    decided = rows.filter("verdict IS NOT NULL").withColumn("label", (F.col("verdict") == "block").cast("double"))
    n = {r["label"]: r["n"] for r in decided.groupBy("label").agg(F.count("*").alias("n")).collect()}
    rest = rows.filter("verdict IS NULL")
    if len(n) < 2:
        only = "block" if 1.0 in n else "allow"
        rest = rest.withColumn("verdict", F.lit(only)).withColumn("p_block", F.lit(None).cast("double"))
    else:
        overall = n[1.0] / (n[0.0] + n[1.0])
        labelled = stored(_lexical(decided), "urls-labelled")
        stats = {k: stored(_statistics(labelled, k, overall), "urls-stats") for k in ("suffix", "segment")}
        chosen = None
        for y in (0.0, 1.0):
            part = labelled.filter(F.col("label") == y).orderBy(stable_hash("url", "id")).limit(per_class)
            chosen = part if chosen is None else chosen.unionByName(part)
        vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
        sample = stored(_with_statistics(chosen, stats, overall).select("label", *FEATURES), "urls-sample")
        model: GBTClassificationModel = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7, maxBins=32).fit(
            vector.transform(sample))
        judged = model.transform(vector.transform(_with_statistics(_lexical(rest), stats, overall)))
        rest = (judged.withColumn("p_block", F.element_at(_to_array(F.col("probability")), 2))
                .withColumn("verdict", F.when(F.col("p_block") > 0.5, "block").otherwise("allow")))
    final = ["id", "host", "path", "rule", "verdict", "p_block"]
    done = decided.withColumn("p_block", F.lit(None).cast("double")).select(*final).unionByName(rest.select(*final))
    return done.withColumnRenamed("id", id_col)


def _to_array(vector):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(vector)
