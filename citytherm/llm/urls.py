"""URL verdicts: site rules first, gradient-boosted trees on lexical features else.

*Rules.*  A rule ``host/path`` fits its host and all subdomains when the url's
path starts with the rule's path; the longest fitting rule decides.

*Trees.*  Urls without a rule are judged by gradient-boosted trees over lexical
features: lengths, depth, digit and hyphen shares, character entropy, parameter
counts and statistics of the host's suffix.  The labels that train them are a list
of words that mark unwanted hosts; the words themselves are not features.
At most ``sample_rows`` urls (smallest hashes) train.

Everything is DataFrame expressions and Spark's own tree learner; no Python runs
on the executors.

Defined cases: a null url, or one without ``://``, has empty host and path, no
rule, and a verdict by the trees from its (empty) features; when the sample holds
one class only, or nothing, urls without a rule are allowed; repeated rows are judged
each; null ids are carried; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.llm.common import table

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
UNWANTED_WORDS = ("casino", "pills", "spam", "ads-", "track", "lottery", "xxx", "bet-", "loans", "viagra")

FEATURES = ["url_length", "host_length", "path_length", "query_length", "host_depth", "path_depth", "digit_share",
            "host_digit_share", "host_hyphens", "host_entropy", "entropy", "parameters", "longest_label", "suffix_rate", "suffix_share"]


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 20_000  # bound on the urls that train
    trees: int = 12
    depth: int = 4
    smoothing: float = 20.0
    seed: int = 17


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path."""
    url = F.coalesce("url", F.lit(""))
    cut = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return pages.select("page_id", "url", lower_ascii(F.regexp_extract(url, cut, 1)).alias("host"), F.regexp_extract(url, cut, 2).alias("path"))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; both null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        h, _, p = text.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(f"/{p}"))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.char_length(text)
    bits = F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda acc, c: acc + F.when(
        c == "", 0.0).otherwise(-(n - F.char_length(F.replace(text, c, F.lit("")))) / n * F.log2((n - F.char_length(F.replace(text, c, F.lit("")))) / n)))
    return F.when(n > 0, bits).otherwise(0.0)


def lexical(rows: DataFrame) -> DataFrame:
    """Add the lexical features (all but the suffix statistics) and the suffix."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    size = lambda c: F.char_length(c).cast("double")
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    return rows.select(
        "*", F.element_at(labels, -1).alias("suffix"),
        size(url).alias("url_length"), size(host).alias("host_length"), size(path).alias("path_length"), size(query).alias("query_length"),
        count(host, r"\.").alias("host_depth"), count(path, "/").alias("path_depth"),
        (count(url, "[0-9]") / F.greatest(size(url), F.lit(1.0))).alias("digit_share"),
        (count(host, "[0-9]") / F.greatest(size(host), F.lit(1.0))).alias("host_digit_share"),
        count(host, "-").alias("host_hyphens"), entropy(host).alias("host_entropy"), entropy(url).alias("entropy"),
        F.when(query == "", 0.0).otherwise(count(query, "&") + 1.0).alias("parameters"),
        F.array_max(F.transform(labels, lambda x: F.char_length(x))).cast("double").alias("longest_label"))


def unwanted(host: Column) -> Column:
    hit = F.lit(False)
    for word in UNWANTED_WORDS:
        hit = hit | F.contains(host, F.lit(word))
    return hit.cast("double")


def judge(pages: DataFrame, s: Settings = Settings(), rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, p_block (the trees' probability)."""
    rows = lexical(parts(pages)).withColumn("label", unwanted(F.col("host")))
    # statistics over all urls of a suffix: smoothed rate of unwanted hosts and share of the table
    overall = rows.agg(F.avg("label").alias("mean"), F.count("*").alias("n")).first()
    mean, n = overall["mean"] or 0.0, max(overall["n"], 1)
    suffixes = rows.groupBy("suffix").agg(
        ((F.sum("label") + s.smoothing * mean) / (F.count("*") + s.smoothing)).alias("suffix_rate"), (F.count("*") / n).alias("suffix_share"))
    rows = rows.join(suffixes, "suffix", "left")
    sample = (rows.where(F.col("host") != "").orderBy(F.xxhash64("url"), "page_id").limit(s.sample_rows)
              .select("label", *FEATURES))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    train = vectors.transform(sample.repartition(1)).select("features", "label").persist()
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    try:
        if train.select("label").distinct().count() < 2:
            judged = rows.withColumn("p_block", F.lit(0.0))
        else:
            model = GBTClassifier(maxIter=s.trees, maxDepth=s.depth, seed=s.seed, stepSize=0.2, cacheNodeIds=False).fit(train)
            judged = model.transform(vectors.transform(rows)).withColumn("p_block", F.get(vector_to_array("probability"), 1))
    finally:
        train.unpersist()
    return judged.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")).alias("verdict"), "p_block")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
