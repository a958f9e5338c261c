"""Mixing to target weights by soft membership.

A naive Bayes classifier, fitted on a labelled table, gives every document a posterior over
domains. Each document gets a rate (how often it is used in an epoch) such that the expected tokens
of each domain, the sum of rate x tokens x posterior, come near the targets. Rates are nonnegative
and near one; they minimise

    1/2 sum_k (tokens_k(rates) / T - target_k)^2 + ridge / 2 sum_d (tokens_d / T) (rate_d - 1)^2

with rates between 0 and ``most``. The rates are found by distributed projected gradient: a step moves
every rate against its gradient, posterior x residual summed over the domains plus the pull to one, and
projects it back between its bounds. The first step is one over the largest curvature (of the Gram
matrix of the posteriors), the next ones come from the last two points (Barzilai and Borwein), and a step
that leaves the value above the last ``REMEMBERED`` ones is shortened. Steps end when the largest projected
gradient is within ``TOLERANCE``. Documents of equal posterior (rounded to three decimals) have equal
rates and are summed before; a step is one aggregate over these cells, of which only sums over domains reach
the driver. With ``most`` = 1 nothing is repeated: what is over its target is thinned, the rest stays.

The classifier knows at most ``vocabulary`` words, those whose class shares differ most in a
sample of at most ``sample`` labelled documents (the bound on fitting), so the table that is
broadcast has a fixed bound. All counts over the corpus cover every row and whole texts.

Defined results: null or empty texts have no tokens and the prior as posterior; labels without a
document, or without a domain, are left out; of several labels of a document the least counts; without any label the
posterior is uniform; repeated rows have one posterior and rate each; an empty table gives an
empty result; other columns pass through ``mix`` untouched, but names that start with ``mix_``
are taken.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.storage import staged

WORDS = r"[\x20\x09-\x0D]+"
MARK = " "  # no word has a blank in it
SAMPLE = 8000
VOCABULARY = 4096
LEAST_DOCS = 5
SHARPNESS = 4.0
DECIMALS = 3
STEPS = 1000  # far more than are needed; a guard against an endless search
REMEMBERED = 10
#: Steps that a plan repeats from the last staged rates.
STAGE_EVERY = 25
RIDGE = 0.001
TOLERANCE = 1e-9


def words_in(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORDS), lambda w: w != "")


def fit_words(docs: DataFrame, labelled: DataFrame, domains: list[str], key: str, text: str, sample: int, vocabulary: int) -> tuple[DataFrame, list[float]]:
    """Log ratios of each word for each domain (``word, l0, l1, ...``), and the log priors."""
    named = labelled.where(F.col(key).isNotNull() & F.col("domain").isin(domains)).groupBy(key).agg(F.min("domain").alias("domain"))
    chosen = named.orderBy(F.xxhash64(key), key).limit(sample)
    # at most ``sample`` rows
    held = docs.select(key, text).join(F.broadcast(chosen), key)
    held = staged(held.select("domain", F.array_distinct(words_in(F.col(text))).alias("words")))
    sizes = {r["domain"]: r["n"] for r in held.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    seen = held.select("domain", F.explode("words").alias("word")).groupBy("word")
    counts = seen.agg(*[F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(f"n{i}") for i, d in enumerate(domains)])
    total = sum(sizes.values())
    k = len(domains)
    log_priors = [math.log((sizes.get(d, 0) + 1) / (total + k)) for d in domains]
    everywhere = sum(F.col(f"n{i}") for i in range(k))
    overall = (everywhere + 1) / F.lit(total + 2)
    # seen over expected, each with one document more: where hardly any is expected, none is no evidence
    ratios = [F.log((F.col(f"n{i}") + 1) / (F.lit(sizes.get(d, 0)) * overall + 1)) for i, d in enumerate(domains)]
    told = counts.where(everywhere >= LEAST_DOCS).select("word", everywhere.alias("seen"), *[r.alias(f"l{i}") for i, r in enumerate(ratios)])
    tells = sum(F.abs(F.col(f"l{i}")) for i in range(k)) * F.sqrt("seen")
    best = told.orderBy(tells.desc(), "word").limit(vocabulary)
    return staged(best.drop("seen")), log_priors


def posteriors(docs: DataFrame, words: DataFrame, log_priors: list[float], key: str, text: str) -> DataFrame:
    """``key, mix_text, mix_copies, mix_tokens, mix_p`` for each key and text: tokens and the posterior over domains."""
    k = len(log_priors)
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\f\r"))
    # a mark after the last word tells how many there are, also of a text without any
    marked = F.concat(F.split(trimmed, WORDS), F.array(F.lit(MARK)))
    # in a projection of its own below the generator, so that hash and cut are made once for each text
    cut = docs.select(F.col(key), F.xxhash64(text).alias("mix_text"), (trimmed == "").cast("long").alias("empty"), marked.alias("marked"))
    each = cut.select(key, "mix_text", "empty", F.posexplode("marked").alias("at", "word"))
    # at most ``vocabulary`` rows; every word keeps its row, so the work is the same whatever words are known
    met = each.join(F.broadcast(words.where(F.col("word") != MARK)), "word", "left")
    last = F.col("word") == MARK
    sums = met.groupBy(key, "mix_text").agg(
        F.sum(F.when(last, F.col("at") - F.col("empty")).otherwise(0)).alias("in_all"),
        F.count_if(last).alias("mix_copies"),
        F.count("l0").alias("hits"),
        *[F.sum(f"l{i}").alias(f"s{i}") for i in range(k)],
    )
    scale = F.lit(SHARPNESS) / F.greatest(F.lit(1.0), F.sqrt(F.col("hits") / F.col("mix_copies")) * F.col("mix_copies"))
    logits = F.array(*[F.lit(log_priors[i]) + F.coalesce(F.col(f"s{i}"), F.lit(0.0)) * scale for i in range(k)])
    grown = sums.select("*", logits.alias("logits")).withColumn("top", F.array_max("logits"))
    grown = grown.withColumn("e", F.transform("logits", lambda x: F.exp(x - F.col("top"))))
    summed = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return grown.select(
        key,
        "mix_text",
        "mix_copies",
        (F.col("in_all") / F.col("mix_copies")).cast("long").alias("mix_tokens"),
        F.transform("e", lambda x: F.round(x / summed, DECIMALS)).alias("mix_p"),
    )


def fit_rates(members: DataFrame, targets: list[float], steps: int = STEPS, ridge: float = RIDGE, most: float = math.inf) -> DataFrame:
    """``mix_p, mix_rate`` for each posterior that occurs."""
    k = len(targets)
    grouped = members.groupBy("mix_p").agg(F.sum(F.col("mix_tokens") * F.col("mix_copies")).cast("double").alias("tokens"))
    cells = staged(grouped.withColumn("start", F.lit(min(1.0, most))))
    p = [F.col("mix_p")[i] for i in range(k)]
    grams = [F.sum(F.col("tokens") * p[i] * p[j]).alias(f"s{i}_{j}") for i in range(k) for j in range(k)]
    first = cells.agg(F.sum("tokens"), *grams).first()
    total = first[0] or 0.0
    if not total:
        return cells.select("mix_p", F.lit(1.0).alias("mix_rate"))
    wanted = np.array(targets, dtype=float)

    def moved(rate: Column, pace: Column | float, missed) -> Column:
        slope = sum(p[i] * missed[i] for i in range(k)) + ridge * (rate - 1)
        free = F.greatest(F.lit(0.0), rate - pace * slope)
        return free if math.isinf(most) else F.least(F.lit(most), free)

    def folded(taken: list[tuple[float, np.ndarray]]) -> Column:
        """The rates after these steps, (pace, residuals) each, from the staged ones."""
        if not taken:
            return F.col("start")
        told = F.array(*[F.struct(F.lit(float(a)).alias("a"), *[F.lit(float(g)).alias(f"g{i}") for i, g in enumerate(r)]) for a, r in taken])
        return F.aggregate(told, F.col("start"), lambda rate, s: moved(rate, s["a"], [s[f"g{i}"] for i in range(k)]))

    def told(taken: list[tuple[float, np.ndarray]], missed: np.ndarray, pace: float) -> tuple[np.ndarray, float, float, float]:
        """After one more step: residuals, value, its squared length; and the projected gradient before it."""
        held = cells.select("mix_p", (F.col("tokens") / total).alias("w"), folded(taken).alias("old"))
        numbers = [F.lit(float(g)) for g in missed]
        both = held.select("*", moved(F.col("old"), pace, numbers).alias("new"), moved(F.col("old"), 1.0, numbers).alias("whole"))
        shares = [F.sum(F.col("w") * F.col("new") * p[i]) for i in range(k)]
        more = [F.sum(F.col("w") * (F.col("new") - c) * (F.col("new") - c)) for c in (F.lit(1.0), F.col("old"))]
        row = both.agg(*shares, *more, F.max(F.abs(F.col("whole") - F.col("old")))).first()
        after = np.array(row[:k]) - wanted
        return after, float(after @ after) / 2 + ridge / 2 * row[k], row[k + 1], row[k + 2]

    curves = np.array(first[1:]).reshape(k, k) / total
    pace = 1.0 / (float(np.linalg.eigvalsh(curves).max()) + ridge)
    missed, value, _, _ = told([], np.zeros(k), 0.0)
    taken: list[tuple[float, np.ndarray]] = []
    recent = [value]
    for _ in range(steps):
        after, value, length, projected = told(taken, missed, pace)
        if projected <= TOLERANCE:
            break
        # values are sums over the corpus, so they are compared up to rounding
        if value > max(recent) + 1e-12 * (1 + max(recent)):
            pace /= 4
            continue
        taken.append((pace, missed))
        bent = float((after - missed) @ (after - missed)) + ridge * length
        pace = min(max(length / bent, 1e-3), 1 / ridge) if bent > 0 else 1 / ridge
        missed, recent = after, [*recent, value][-REMEMBERED:]
        if len(taken) == STAGE_EVERY:
            cells, taken = staged(cells.select("mix_p", "tokens", folded(taken).alias("start"))), []
    return staged(cells.select("mix_p", folded(taken).alias("mix_rate")))


def mixing_rates(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    key: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    vocabulary: int = VOCABULARY,
    most: float = math.inf,
) -> DataFrame:
    """``key, mix_text, mix_copies, mix_tokens, mix_p, mix_rate`` for each key and text.

    ``labelled`` has the key and ``domain``; ``targets`` are the wanted shares of tokens by domain;
    no rate is above ``most``.
    """
    domains = sorted(targets)
    whole = sum(targets.values())
    words, log_priors = fit_words(docs, labelled, domains, key, text, sample, vocabulary)
    members = staged(posteriors(docs, words, log_priors, key, text))
    rates = fit_rates(members, [targets[d] / whole for d in domains], most=most)
    return members.join(rates, "mix_p")


def mix(docs: DataFrame, rates: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says: its whole part, and one more with the chance of the rest."""
    part = F.pmod(F.xxhash64(F.col(key), F.col("mix_text"), F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    times = rates.select(key, "mix_text", F.floor(F.col("mix_rate") + part).cast("int").alias("mix_times")).where("mix_times > 0")
    times = times.withColumnRenamed(key, "mix_key")
    tagged = docs.withColumn("mix_text", F.xxhash64(text))
    same = F.col(key).eqNullSafe(F.col("mix_key")) & (tagged["mix_text"] == times["mix_text"])
    met = tagged.join(times, same).withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_times"))))
    return met.select(*[F.col(f"`{c}`") for c in docs.columns])
