"""Document quality by hierarchical empirical Bayes.

*Evidence of the text.*  Shape measures of a text (shares of symbols, capitals,
digits, white space, bars and exclamation marks, word length, repeated words,
length) are binned on fixed grids.  Per measure and bin, a grouped aggregate over
the labelled training rows gives a smoothed log likelihood ratio of good over
bad; a document's evidence is the sum over its bins, damped because the
measures are correlated.

*Evidence of the site.*  The labelled good rate of every host, and of every path
(section) of a host, is shrunk: a host's posterior starts from the global rate, a
path's from its host's posterior.  How strongly is estimated from the spread of
the rates over the groups beyond what chance explains (method of moments), so
sparse sites fall back to their parents and large ones speak for themselves.

*Score.*  The path's posterior log odds plus the text's evidence, as a probability.

``documents`` have no url: the host is ``source`` and the path the language
section below it.  Labels of the held-out fold are never read.  All statistics are
grouped sums with partial aggregation; a host with a third of all rows adds
one row per task.  What goes to the driver is one row per measure and bin.

Defined cases: null texts count as empty; null source or language is a group of
its own; labels without a document and documents without a label are allowed; with
no labels (or one class only) smoothing leaves a rate near 0.5 from the prior;
several labels of one id count as the largest; repeated rows are scored each;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citytherm.llm.common import held_out, stage, table


@dataclass(frozen=True)
class Settings:
    smoothing: float = 1.0
    damping: float = 0.5
    least_strength: float = 2.0
    most_strength: float = 10_000.0


def measures() -> dict[str, tuple[Column, list[float]]]:
    """name -> (value of ``text``, upper limits of its bins)."""
    text = F.col("text")
    n = F.greatest(F.char_length(text), F.lit(1))
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / n
    count = F.size(F.col("tokens"))
    return {
        "symbols": (share(r"[#$%&*+=<>@\\^_`{}~\[\]]"), [0.0, 0.005, 0.02, 0.05, 0.1, 0.2]),
        "bars": (share(r"\|"), [0.0, 0.005, 0.02, 0.05, 0.1]),
        "shouts": (share(r"!"), [0.0, 0.002, 0.01, 0.03, 0.1]),
        "capitals": (share(r"[A-Z]"), [0.0, 0.02, 0.05, 0.1, 0.3, 0.6]),
        "digits": (share(r"[0-9]"), [0.0, 0.005, 0.02, 0.1, 0.3]),
        "word_length": (F.when(count > 0, F.char_length(text) / count).otherwise(0.0), [2.0, 4.0, 5.0, 6.0, 7.0, 8.0, 10.0, 15.0]),
        "distinct_words": (F.when(count > 0, F.size(F.array_distinct(F.col("tokens"))) / count).otherwise(0.0), [0.05, 0.2, 0.4, 0.6, 0.8, 0.99]),
        "length": (F.log2(n), [4.0, 6.0, 8.0, 10.0, 12.0, 14.0]),
    }


def binned(documents: DataFrame) -> DataFrame:
    """doc_id, host, path, bins: the bin of every measure."""
    rows = documents.select("doc_id", F.col("source").alias("host"), F.col("lang").alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tokens", F.split(F.trim("text"), r"\s+"))
    values, limits = zip(*measures().values())
    grid = F.array(*[F.array(*[F.lit(x) for x in row]) for row in limits])
    # each measure is an element of one array, so it is computed once for all its limits
    bins = F.transform(F.array(*[v.cast("double") for v in values]),
                       lambda v, i: F.size(F.filter(F.get(grid, i), lambda limit: limit < v)))
    return rows.select("doc_id", "host", "path", bins.alias("bins"))


def posterior(groups: DataFrame, parent: str, name: str, s: Settings) -> DataFrame:
    """Add ``name``: the posterior good rate of groups (n, good) whose prior mean
    is the column ``parent``; the prior's strength comes from the groups' spread."""
    rate = F.col("good") / F.col("n")
    spread = F.sum(F.col("n") * (rate - F.col(parent)) ** 2)
    chance = F.sum(F.col(parent) * (1 - F.col(parent)))  # expected n * (rate - mean)^2 of a group is p(1-p) by chance
    row = groups.agg(spread.alias("spread"), chance.alias("chance"), F.sum("n").alias("n"), F.avg(F.col(parent) * (1 - F.col(parent))).alias("pq")).first()
    extra = max((row["spread"] or 0.0) - (row["chance"] or 0.0), 0.0) / max(row["n"] or 0, 1)
    strength = s.most_strength if extra <= 0 else min(max((row["pq"] or 0.25) / extra - 1, s.least_strength), s.most_strength)
    return groups.withColumn(name, (F.col("good") + strength * F.col(parent)) / (F.col("n") + strength))


def fit(features: DataFrame, labels: DataFrame, s: Settings = Settings()) -> tuple[Column, DataFrame, DataFrame, float]:
    """Evidence of ``bins``, host posteriors, path posteriors and the global rate."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("quality").cast("int").alias("y")))
    train = features.join(known, "doc_id")
    counts = (train.select("host", "path", "y", F.posexplode("bins").alias("measure", "bin"))
              .groupBy("measure", "bin").agg(F.sum("y").alias("good"), F.sum(1 - F.col("y")).alias("bad")).collect())
    total = {}
    for r in counts:
        g, b, k = total.get(r["measure"], (0, 0, 0))
        total[r["measure"]] = (g + r["good"], b + r["bad"], k + 1)
    weight = {}
    for r in counts:
        g, b, k = total[r["measure"]]
        weight[r["measure"], r["bin"]] = s.damping * (math.log((r["good"] + s.smoothing) / (g + k * s.smoothing))
                                                      - math.log((r["bad"] + s.smoothing) / (b + k * s.smoothing)))
    evidence = F.lit(0.0)
    for m, (_, limits) in enumerate(measures().values()):
        row = F.array(*[F.lit(weight.get((m, b), 0.0)) for b in range(len(limits) + 1)])
        evidence = evidence + F.get(row, F.get("bins", m))
    paths = train.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("y").alias("good"))
    g, b, _ = total.get(0, (0, 0, 0))
    mean = (g + s.smoothing) / (g + b + 2 * s.smoothing)
    hosts = posterior(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn("prior", F.lit(mean)),
                      "prior", "host_rate", s).select("host", "host_rate")
    below = paths.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h")
    return evidence, hosts, posterior(below, "host_rate", "path_rate", s).select("host", "path", "path_rate"), mean


def score(documents: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, evidence, site_rate, quality_score."""
    features = stage(binned(documents), "bins")  # a few numbers per text, read by the fit and the score
    evidence, hosts, paths, mean = fit(features, labels, s)
    h = hosts.select(F.col("host").alias("h"), "host_rate")
    p = paths.select(F.col("host").alias("ph"), F.col("path").alias("pp"), "path_rate")
    rows = (features.select("doc_id", "host", "path", evidence.alias("evidence"))
            .join(h, F.col("host").eqNullSafe(F.col("h")), "left")
            .join(p, F.col("host").eqNullSafe(F.col("ph")) & F.col("path").eqNullSafe(F.col("pp")), "left")
            .withColumn("site_rate", F.coalesce("path_rate", "host_rate", F.lit(mean))))
    odds = F.log(F.col("site_rate") / (1 - F.col("site_rate"))) + F.col("evidence")
    return rows.select("doc_id", "evidence", "site_rate", (1 / (1 + F.exp(-odds))).alias("quality_score"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, and whether it is kept."""
    return (score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
            .select("doc_id", "quality_score", "evidence", "site_rate", (F.col("quality_score") >= 0.5).alias("kept")))
