"""URL filter by the ratio of two character language models.

Rules of hosts and paths judge what they fit; the longest rule wins. The URLs that rules judge
train two variable-order Markov models, one of accepted and one of rejected URLs: the chance
of a character after the four before it, smoothed down to shorter contexts by Witten-Bell weights
and last to a uniform one. A URL that no rule fits is judged by its log-likelihood ratio for
each character, against a threshold that is calibrated on a fifth of the judged URLs, which
the models have not seen.

Counts of all five-character strings of the whole table, with those of shorter ones summed from
them, stay distributed; their log ratios are joined to the places of each distinct URL text.
Only a histogram of calibration scores (a fixed number of bins) reaches the driver.

Defined results: a null URL, or one without ``://``, has an empty host and path; rules fit no empty
host; a URL without any character to score has no score and is blocked; without judged URLs of both
kinds the threshold is 0; repeated rows are judged each and train once; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.storage import staged

ORDER = 5  # characters of the longest strings that are counted
SYMBOLS = 256.0
PAD = "\x02"
BINS = 100  # of calibration, for each unit of the score
WIDEST = 20


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains, below a path."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host in lower case (A-Z only) and the path, both empty where there is no ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(ordered):
        fits = rule.fits(host, path)
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def places(texts: DataFrame) -> DataFrame:
    """A row for each character of ``text``, with the characters before it in ``gram``."""
    signs = F.split(F.concat(F.lit(PAD * (ORDER - 1)), F.col("text")), "")
    grams = F.transform(F.sequence(F.lit(1), F.char_length("text")), lambda i: F.array_join(F.slice("signs", i, ORDER), ""))
    return texts.where(F.char_length("text") > 0).withColumn("signs", signs).select(
        *texts.columns, F.explode(grams).alias("gram")
    )


def log_ratios(grams: DataFrame) -> DataFrame:
    """``gram, ratio`` for strings with their counts ``yes`` and ``no`` among accepted and rejected URLs."""
    levels = [grams.select("gram", "yes", "no")]
    for length in range(ORDER - 1, 0, -1):
        shorter = levels[-1].groupBy(F.substr("gram", F.lit(2)).alias("gram"))
        levels.append(staged(shorter.agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))))
    known = None
    for length, level in zip(range(1, ORDER + 1), reversed(levels), strict=True):
        told = level.withColumn("context", F.substr("gram", F.lit(1), F.lit(length - 1)))
        sums = told.groupBy("context").agg(
            *[F.sum(k).alias(f"{k}_all") for k in ("yes", "no")],
            *[F.sum((F.col(k) > 0).cast("long")).alias(f"{k}_kinds") for k in ("yes", "no")],
        )
        joined = told.join(sums, "context").withColumn("shorter", F.substr("gram", F.lit(2)))
        if known is None:
            joined = joined.withColumns({"p_yes": F.lit(1 / SYMBOLS), "p_no": F.lit(1 / SYMBOLS)})
        else:
            joined = joined.join(known, "shorter")
        new = {}
        for k in ("yes", "no"):
            weight = F.col(f"{k}_all") + F.col(f"{k}_kinds")
            mixed = (F.col(k) + F.col(f"{k}_kinds") * F.col(f"p_{k}")) / weight
            new[k] = F.when(weight > 0, mixed).otherwise(F.col(f"p_{k}"))
        known = joined.select(F.col("gram").alias("shorter"), new["yes"].alias("p_yes"), new["no"].alias("p_no"))
    return known.select(F.col("shorter").alias("gram"), (F.log("p_yes") - F.log("p_no")).alias("ratio"))


def calibrated(scores: DataFrame) -> float:
    """The threshold on ``score`` with the best mean of both shares of right verdicts."""
    bins = F.greatest(F.lit(-WIDEST * BINS), F.least(F.lit(WIDEST * BINS), F.floor(F.col("score") * BINS)))
    counted = scores.groupBy(bins.cast("int").alias("bin")).agg(
        F.sum((F.col("verdict") == "allow").cast("long")).alias("yes"), F.sum((F.col("verdict") == "block").cast("long")).alias("no")
    )
    rows = sorted((r["bin"], r["yes"], r["no"]) for r in counted.collect())
    yes, no = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not yes or not no:
        return 0.0
    best, threshold, below_yes, below_no = 1.0, rows[0][0] / BINS, 0, 0
    for i, (b, y, n) in enumerate(rows):
        below_yes, below_no = below_yes + y, below_no + n
        if i + 1 == len(rows):
            break
        right = (yes - below_yes) / yes + below_no / no
        if right > best:
            # half way to the next score that occurs, so that rounding decides nothing
            best, threshold = right, (b + 1 + rows[i + 1][0]) / 2 / BINS
    return threshold


def judge_urls(pages: DataFrame, rules: list[Rule], keep: list[str], url: str = "url") -> DataFrame:
    """The columns ``keep`` with ``host, path, rule, verdict, score`` (replacing their like) for every row."""
    keep = [c for c in keep if c.lower() not in ("host", "path", "rule", "verdict", "score", "text", "by_rule")]
    host, path = host_and_path(F.col(url))
    split = pages.select(*keep, host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    split = split.withColumns({"rule": rule, "by_rule": verdict, "text": F.concat("host", "path")})

    # a host holds no slash, so each text parts into host and path in one way and has one verdict
    texts = staged(split.groupBy("text").agg(F.min("by_rule").alias("verdict")))
    held = F.pmod(F.crc32("text"), F.lit(5)) == 0
    each = places(texts.withColumn("trains", ~held))
    counts = each.groupBy("gram").agg(
        F.sum((F.col("trains") & (F.col("verdict") == "allow")).cast("long")).alias("yes"),
        F.sum((F.col("trains") & (F.col("verdict") == "block")).cast("long")).alias("no"),
    )
    counts = staged(counts.select("gram", *[F.coalesce(k, F.lit(0)).alias(k) for k in ("yes", "no")]))
    ratios = staged(log_ratios(counts))
    scored = each.select("text", "verdict", "trains", "gram").join(ratios, "gram").groupBy("text")
    scored = scored.agg(F.round(F.avg("ratio"), 6).alias("score"), F.first("verdict").alias("verdict"), F.first("trains").alias("trains"))
    scored = staged(scored)
    threshold = calibrated(scored.where(~F.col("trains") & F.col("verdict").isNotNull()))
    method = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return split.join(scored.select("text", "score"), "text", "left").select(
        *keep, "host", "path", "rule", F.coalesce(F.col("by_rule"), method).alias("verdict"), "score"
    )
