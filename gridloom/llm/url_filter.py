"""URL filters: rules by host and path, and gradient-boosted trees for the rest.

All of it is DataFrame functions and Spark's own GBTClassifier: lexical features are
column expressions, suffix statistics come from one aggregation of the labelled
URLs, and the trees are trained on a bounded sample of them (`max_rows`), for which
a row's suffix statistics come from the other half of the labelled URLs.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, hash_limit

#: The rules that the query's contract states.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def parts(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path); both empty for null or without `://`."""
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, PARTS, 1), UPPER, SMALL), F.regexp_extract(text, PARTS, 2)


def matching_rule(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits, as struct(size, rule, verdict), or null. A rule is written
    host/path; of two as long the later by name wins. Rules are a stated list, not data."""
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    known = F.array(
        *(
            F.struct(F.lit(len(r)).alias("size"), F.lit(r).alias("rule"), F.lit(v).alias("verdict"), F.lit(r.partition("/")[0].lower()).alias("host"), F.lit("/" + r.partition("/")[2]).alias("path"))
            for v, r in rules
        )
    )
    dotted = F.concat(F.lit("."), host)
    fits = F.filter(known, lambda r: F.endswith(dotted, F.concat(F.lit("."), r["host"])) & F.startswith(path, r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(r["size"].alias("size"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    return F.when(host != "", best)


def times(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for an empty text."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    share = F.transform(F.array_distinct(F.split(text, "")), lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.aggregate(F.filter(share, lambda p: p > 0), F.lit(0.0), lambda total, p: total - p * F.log2(p))


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    length = lambda c: F.length(c).cast("double")
    return {
        "f_length": length(text),
        "f_host_length": length(host),
        "f_path_length": length(path),
        "f_depth": times(path, "/[^/]"),
        "f_labels": times(host, "[.]"),
        "f_hyphens": times(host, "-"),
        "f_digit_ratio": times(text, "[0-9]") / F.greatest(length(text), F.lit(1.0)),
        "f_host_digits": times(host, "[0-9]"),
        "f_entropy": entropy(text),
        "f_host_entropy": entropy(host),
        "f_parameters": times(F.regexp_extract(text, r"(?s)[?]([^#]*)", 1), "[^&]+"),
        "f_fragment": F.contains(text, F.lit("#")).cast("double"),
        "f_secure": F.startswith(F.lower(text), F.lit("https")).cast("double"),
        "f_extension": F.coalesce(F.regexp_like(path, F.lit("[.][A-Za-z0-9]{1,5}$")).cast("double"), F.lit(0.0)),
    }


def with_suffix(pages: DataFrame, stats: DataFrame, prior: float, own: Column) -> DataFrame:
    """Adds the share of blocked labelled URLs of a host's last label, and how many there are.

    `stats` has their numbers by halves; `own` is the half that doesn't count for a row, if any."""
    blocked, count = (F.when(own == 0, F.col(c + "1")).when(own == 1, F.col(c + "0")).otherwise(F.col(c + "0") + F.col(c + "1")) for c in ("_blocked", "_count"))
    found = pages.join(stats, "_suffix", "left").withColumn("f_suffix_count", F.coalesce(count, F.lit(0.0)))
    share = F.when(F.col("f_suffix_count") > 0, blocked / F.col("f_suffix_count"))
    return found.withColumn("f_suffix_share", F.coalesce(share, F.lit(prior))).drop("_blocked0", "_blocked1", "_count0", "_count1", "_suffix")


def suffix_stats(labelled: DataFrame) -> DataFrame:
    """Per last label the numbers of labelled and of blocked URLs, in each half of the URLs."""
    of = lambda half, c: F.sum(F.when(F.col("_half") == half, c).otherwise(0.0))
    return labelled.groupBy("_suffix").agg(*(of(k, c).alias(f"{n}{k}") for k in (0, 1) for n, c in (("_blocked", F.col("label")), ("_count", F.lit(1.0)))))


def judge(pages: DataFrame, rules=RULES, max_rows: int = 20_000, iterations: int = 10, depth: int = 4) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict and score (the trees' probability of block).

    A URL that a rule fits gets the rule's verdict and serves as labelled; all others
    get the trees'. Null URLs have empty host and path and are judged by the trees. URLs of
    any length are read whole.
    Repeated rows are judged alike; other columns don't matter. Without labelled
    URLs of both kinds the trees are replaced by the one kind there is, else allow.
    Last labels of which no labelled URL is known count as the mean.
    """
    scratch = Scratch(pages.sparkSession, "url-filter")
    host, path = parts(F.col("url"))
    base = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    base = base.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules)).withColumn("_suffix", F.regexp_extract("host", "([^.]*)$", 1))
    known = base.where("_rule is not null").select("page_id", "url", "host", "path", "_suffix", (F.col("_rule.verdict") == "block").cast("double").alias("label"), F.pmod(F.xxhash64("url"), F.lit(2)).alias("_half"))
    stats = scratch.write(suffix_stats(known), "stats")
    sums = stats.agg(F.sum(F.col("_count0") + F.col("_count1")).alias("n"), F.sum(F.col("_blocked0") + F.col("_blocked1")).alias("blocked")).first()
    out = ["page_id", "host", "path", F.col("_rule.rule").alias("rule")]
    if not sums.n or sums.blocked in (0.0, sums.n):
        only = "block" if sums.n and sums.blocked else "allow"
        return base.select(*out, F.coalesce("_rule.verdict", F.lit(only)).alias("verdict"), F.lit(1.0 if only == "block" else 0.0).alias("score"))
    prior, features = sums.blocked / sums.n, lexical(F.col("url"), F.col("host"), F.col("path"))
    assemble = VectorAssembler(inputCols=[*features, "f_suffix_share", "f_suffix_count"], outputCol="features")
    chosen = known.where(F.xxhash64("url", "page_id") <= F.lit(hash_limit(min(1.0, max_rows / sums.n)))).withColumns(features)
    sample = scratch.write(with_suffix(chosen, stats, prior, F.col("_half")), "sample")
    rows = assemble.transform(sample).select("label", "features").repartition(4).cache()
    trees = GBTClassifier(maxIter=iterations, maxDepth=depth, maxBins=32, stepSize=0.3, seed=1).fit(rows)
    rows.unpersist()
    scored = trees.transform(assemble.transform(with_suffix(base.withColumns(features), stats, prior, F.lit(None)))).withColumn("score", vector_to_array("probability")[1])
    verdict = F.coalesce("_rule.verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select(*out, verdict.alias("verdict"), "score")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row of `pages`; see judge."""
    return judge(documents(spark, sf_dir, "pages"))
