"""URL filtering: host and path rules, and gradient-boosted trees on
lexical features where no rule fits.

The longest fitting rule decides.  The URLs that rules decide are the
labelled URLs the trees learn from; a bounded sample of them
(``SAMPLE``, chosen by a hash of the URL) fits the classifier.  Its
features come from the URL's text alone: lengths, depth, digit ratio,
character entropy, parameter counts, and how often the rules block the
host's suffix and first path part (smoothed, counted over all labelled
URLs).  Predictions run over every row.

Everything is DataFrame functions and Spark's own tree learner in the
JVM.  A row's host, path, rule and features are computed where it is
read.  One pass counts the labelled URLs of each (suffix, first part);
the statistics that follow from it are tables in the shared folder, so
that Spark knows their sizes and broadcasts them if they are small.

Defined results.  Null URL, or one without ``://``: empty host and path,
no rule, and the verdict of the trees.  If the labelled URLs show one
verdict only, that is the verdict of all others; if there are none,
``allow``.  Equal rules cannot tie, as rules are distinct; repeated rows
give repeated results, an empty table none.  URLs of any length are read
whole.  Other columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import cut_lineage
from ledgerline.session import scratch_path

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
         ("net/fr/", "block")]
SAMPLE = 20_000
SAMPLE_PARTS = 8  # of the bounded sample, which every tree level reads
TREES = 10
DEPTH = 4
PRIOR = 10.0
FEATURES = ["url_length", "host_length", "path_length", "host_parts", "depth", "digit_ratio", "entropy", "parameters",
            "query_length", "has_fragment", "is_https", "longest_part", "hyphens", "suffix_blocked", "first_blocked"]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(text, _URL, 1), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(text, _URL, 2)


def rule_column(host: Column, path: Column, rules: list[tuple[str, str]], value: int) -> Column:
    """Of the longest fitting rule its text (0) or verdict (1), else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[0])):
        rule_host, slash, rest = rule[0].partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule[value])).otherwise(out)
    return out


def lexical_features(pages: DataFrame) -> DataFrame:
    """``pages`` (url, host, path) with the features that need no counts,
    and the keys of those that do."""
    url = F.coalesce(F.col("url"), F.lit(""))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    length = F.greatest(F.length(url), F.lit(1))
    share = "(length(u) - length(replace(u, c, ''))) / length(u)"
    entropy = F.expr("transform(array(coalesce(url, '')), u -> aggregate(array_distinct(split(u, '')), 0D, "
                     f"(t, c) -> t - IF(c = '', 0D, {share} * log2({share}))))[0]")
    first = F.element_at(F.split("path", "/"), 2)
    return pages.select(
        "*", length.cast("double").alias("url_length"), F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        F.size(F.split("host", r"\.")).cast("double").alias("host_parts"),
        F.length(F.regexp_replace("path", "[^/]", "")).cast("double").alias("depth"),
        (F.length(F.regexp_replace(url, "[^0-9]", "")) / length).alias("digit_ratio"), entropy.alias("entropy"),
        F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")).alias("parameters"),
        F.length(query).cast("double").alias("query_length"), url.contains("#").cast("double").alias("has_fragment"),
        F.lower(url).startswith("https://").cast("double").alias("is_https"),
        F.array_max(F.transform(F.split("host", r"\."), F.length)).cast("double").alias("longest_part"),
        F.length(F.regexp_replace("host", "[^-]", "")).cast("double").alias("hyphens"),
        F.substring_index("host", ".", -1).alias("suffix"),
        F.when(F.size(F.split("path", "/")) > 1, F.coalesce(first, F.lit(""))).otherwise("").alias("first"))


def _blocked_share(counts: DataFrame, key: str, prior: float) -> DataFrame:
    rate = (F.sum("blocked") + PRIOR * prior) / (F.sum("n") + PRIOR)
    path = scratch_path(counts.sparkSession, f"urlfilter-{uuid.uuid4().hex}-{key}")
    counts.groupBy(key).agg(rate.alias(f"{key}_blocked")).write.parquet(path)
    return counts.sparkSession.read.parquet(path)


def judge(pages: DataFrame, rules: list[tuple[str, str]] | None = None, sample: int = SAMPLE) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row."""
    rules = RULES if rules is None else rules
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.select("*", host.alias("host"), path.alias("path"))
    rows = rows.select("*", rule_column(F.col("host"), F.col("path"), rules, 0).alias("rule"),
                       rule_column(F.col("host"), F.col("path"), rules, 1).alias("ruled"))
    labelled = rows.where("ruled IS NOT NULL").withColumn("label", (F.col("ruled") == "block").cast("double"))
    counts = cut_lineage(lexical_features(labelled).groupBy("suffix", "first").agg(
        F.count("*").alias("n"), F.sum("label").alias("blocked")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                       F.coalesce(F.sum("blocked"), F.lit(0.0)).alias("blocked")).first()
    n, blocked = total["n"], total["blocked"]
    if blocked == 0 or blocked == n:
        other = F.lit("block" if n and blocked == n else "allow")
        return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", other).alias("verdict"))

    prior = blocked / n
    shares = [(k, _blocked_share(counts, k, prior)) for k in ("suffix", "first")]

    def with_features(df: DataFrame) -> DataFrame:
        df = lexical_features(df)
        for key, share in shares:
            df = df.join(share, key, "left").fillna({f"{key}_blocked": prior})
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)

    # Different URLs, each weighted by its rows: copies make the sample no larger.
    different = labelled.agg(F.approx_count_distinct("url").alias("n")).first()["n"]
    spot = F.pmod(F.xxhash64("url"), F.lit(1_000_003)) / 1_000_003.0
    chosen = labelled.where(spot < min(1.0, sample / max(different, 1))).groupBy("url", "host", "path", "label").agg(
        F.count("*").cast("double").alias("weight"))
    chosen = with_features(chosen).select("features", "label", "weight")
    chosen = chosen.repartition(SAMPLE_PARTS).cache()
    try:
        seen = {r["label"] for r in chosen.select("label").distinct().collect()}
        if len(seen) < 2:
            other = F.lit("block" if prior > 0.5 else "allow")
            return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", other).alias("verdict"))
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, weightCol="weight").fit(chosen)
    finally:
        chosen.unpersist()
    judged = model.transform(with_features(rows))
    by_trees = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_trees).alias("verdict"))
