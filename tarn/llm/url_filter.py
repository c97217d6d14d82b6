"""URL filter: rules first, then the ratio of two character language models.

A rule names a host and the start of a path; it fits its host and all subdomains,
and the longest fitting rule decides. URLs that no rule decides are judged by two
smoothed variable-order Markov models over the characters of host and path, one of
the accepted and one of the rejected URLs, both counted over all URLs that a rule
decides. A URL's score is the difference of its two log-likelihoods divided by its
length. The cutoff is calibrated by folds of hosts: each decided URL is scored with the
counts of all folds but its host's. The URLs that are judged are scored with all counts.

Characters are first mapped to an alphabet of 40, so there are at most 40 to the
power of order + 1 strings to count, for each fold left out and for none: that bounds
the model table for any input. It is counted, and broadcast to the URLs if it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import column, small_join
from tarn.session import stage

LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789./-"
OTHER = "?"
START = "^"  # counted as a context only
ORDER = 3
SMOOTHING = 4.0
FOLDS = 5  # of hosts, to calibrate the cutoff
ALL = -1  # the model that leaves no fold out
BINS, REACH = 400, 4.0

# verdict, host, start of the path
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty if it is null or has no ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    known = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(known, parts, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(known, parts, 2)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of its text and verdict; null if none does.

    Of rules of one length the one with the longer host wins, then the first by text.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[1] + r[2]))
    found = []
    for verdict, of_host, start in ordered:
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(start)
        found.append(F.when(fits, F.struct(F.lit(of_host + start).alias("rule"), F.lit(verdict).alias("verdict"))))
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*found, none)


def _spelled(host: Column, path: Column) -> Column:
    lower = F.translate(F.concat(host, path), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(lower, "[^" + LETTERS.replace("-", r"\-") + "]", OTHER)


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """Each character of ``_text`` with the characters before it, as ``_gram``."""
    padded = F.concat(F.lit(START * order), F.col("_text"))
    starts = F.when(F.length("_text") > 0, F.sequence(F.lit(1), F.length("_text")))
    return urls.withColumn("_at", F.explode(starts)).withColumn("_gram", F.substring(padded, F.col("_at"), order + 1)).drop("_at")


def markov_ratio(grams: DataFrame, order: int = ORDER, smoothing: float = SMOOTHING, keys: tuple[str, ...] = ()) -> DataFrame:
    """log p_accepted - log p_rejected of the last character of every string, given those before.

    ``grams`` has ``_gram`` (order + 1 characters), ``accepted`` and ``rejected`` counts; a model
    is made for each value of ``keys``. The estimate of a context is mixed with that of the
    context one shorter, with the weight ``smoothing`` against the context's own count; without
    any context stands an even spread over the alphabet.
    """
    classes = ("accepted", "rejected")
    sums = [F.sum(c).alias(c) for c in classes]
    levels = None
    for length in range(1, order + 2):
        counts = grams.groupBy(*keys, F.expr(f"right(_gram, {length})").alias("_tail")).agg(*sums)
        # the context's count, which is the sum over its next characters
        context = F.expr(f"left(_tail, {length - 1})")
        totals = counts.groupBy(*keys, context.alias("_context")).agg(*[F.sum(c).alias(f"{c}_all") for c in classes])
        joined = counts.withColumn("_context", context).join(totals, [*keys, "_context"])
        if levels is None:
            even = F.lit(1.0 / (len(LETTERS) + 1))
            shorter = {c: even for c in classes}
        else:
            joined = joined.withColumn("_shorter", F.expr(f"right(_tail, {length - 1})")).join(levels, [*keys, "_shorter"])
            shorter = {c: F.col(f"p_{c}") for c in classes}
        # stage by stage, so that a level is computed once; the tables have a bound
        levels = joined.select(
            *keys, F.col("_tail").alias("_shorter"),
            *[((F.col(c) + smoothing * shorter[c]) / (F.col(f"{c}_all") + smoothing)).alias(f"p_{c}") for c in classes],
        )
        levels = stage(levels, "markov")
    ratio = F.log("p_accepted") - F.log("p_rejected")
    return levels.select(*keys, F.col("_shorter").alias("_gram"), ratio.alias("_ratio"))


def _models(grams: DataFrame) -> DataFrame:
    """``_gram``, ``_model``, ``accepted`` and ``rejected``: counts of all decided URLs, and without each fold of hosts."""
    classes = ("accepted", "rejected")
    pages = {"accepted": F.when(F.col("_label") == "allow", F.col("_pages")), "rejected": F.when(F.col("_label") == "block", F.col("_pages"))}
    per_fold = [F.coalesce(F.sum(F.when(F.col("_fold") == f, pages[c])), F.lit(0)).alias(f"{c}{f}") for c in classes for f in range(FOLDS)]
    counts = grams.groupBy("_gram").agg(*per_fold)
    total = {c: sum((F.col(f"{c}{f}") for f in range(FOLDS)), F.lit(0)) for c in classes}
    models = [F.struct(F.lit(ALL).alias("_model"), *[total[c].alias(c) for c in classes])]
    models += [F.struct(F.lit(f).alias("_model"), *[(total[c] - F.col(f"{c}{f}")).alias(c) for c in classes]) for f in range(FOLDS)]
    return counts.select("_gram", F.explode(F.array(*models)).alias("_m")).select("_gram", "_m.*")


def _calibrated(held: DataFrame) -> float:
    """The cutoff with the best balanced accuracy on decided URLs, from a histogram of their scores.

    Scores are counted in a fixed number of bins. Without both classes the cutoff is 0.
    """
    wide = 2 * REACH / BINS
    place = F.floor((F.col("_score") + REACH) / wide)
    bins = held.groupBy(F.least(F.greatest(place, F.lit(0)), F.lit(BINS - 1)).alias("bin")).agg(
        F.sum(F.when(F.col("_label") == "allow", 1).otherwise(0)).alias("allow"),
        F.sum(F.when(F.col("_label") == "block", 1).otherwise(0)).alias("block"),
    )
    counted = {r["bin"]: r for r in bins.collect()}  # at most BINS rows
    allow, block = (sum(r[c] for r in counted.values()) for c in ("allow", "block"))
    if not allow or not block:
        return 0.0
    best, cutoff, lost, stopped = -1.0, 0.0, 0, 0
    # of equally good cutoffs the one nearest to 0
    for edge in range(BINS + 1):
        at = edge * wide - REACH
        good = (allow - lost) / allow + stopped / block
        if good > best + 1e-12 or (abs(good - best) <= 1e-12 and abs(at) < abs(cutoff)):
            best, cutoff = good, at
        if edge in counted:
            lost, stopped = lost + counted[edge]["allow"], stopped + counted[edge]["block"]
    return cutoff


def filter_urls(
    pages: DataFrame, id: str = "page_id", url: str = "url", rules=RULES, order: int = ORDER,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict and the score, which is null where a rule decides.

    A null URL and one without ``://`` have an empty host and path, score 0 and are
    judged by the cutoff like others. Repeated URLs get equal verdicts. Without
    decided URLs all scores are 0 and the rest is allowed. An empty table gives an empty
    result; other columns are not read.
    """
    host, path = host_and_path(column(url))
    parsed = pages.select(column(id).alias("_id"), host.alias("_host"), path.alias("_path"))
    parsed = parsed.withColumn("_rule", rule_for(F.col("_host"), F.col("_path"), rules))
    # every page counts, but each distinct address is spelled out once
    urls = stage(
        parsed.groupBy("_host", "_path", "_rule").agg(F.count(F.lit(1)).alias("_pages")).select(
            "_host", "_path", F.col("_rule.verdict").alias("_label"), "_pages",
            F.pmod(F.xxhash64("_host"), F.lit(FOLDS)).cast("int").alias("_fold"),
            _spelled(F.col("_host"), F.col("_path")).alias("_text"),
        ),
        "urls",
    )
    grams = _grams(urls, order).withColumn("_model", F.when(F.col("_label").isNull(), F.lit(ALL)).otherwise(F.col("_fold")))
    ratios = stage(markov_ratio(stage(_models(grams), "grams"), order, smoothing, ("_model",)), "ratios")
    scores = small_join(grams, ratios, ["_gram", "_model"], "inner").groupBy("_host", "_path").agg(
        F.round(F.avg("_ratio"), 6).alias("_score"), F.first("_label").alias("_label")
    )
    scores = stage(scores, "scores")
    cutoff = _calibrated(scores.filter("_label is not null"))
    undecided = scores.filter("_label is null").select("_host", "_path", "_score")
    judged = parsed.join(undecided, ["_host", "_path"], "left")
    score = F.when(F.col("_rule").isNull(), F.coalesce("_score", F.lit(0.0)))
    by_model = F.when(score >= F.lit(cutoff), "allow").otherwise("block")
    return judged.select(
        F.col("_id").alias(id), F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_rule.rule").alias("rule"), F.coalesce(F.col("_rule.verdict"), by_model).alias("verdict"),
        score.alias("score"),
    )
