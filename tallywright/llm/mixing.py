"""Mixing to target weights with soft membership.

1. Domains come from a labelled table.  A naive Bayes classifier over binned text statistics
   (counts of bins per domain over all labelled rows) gives every document posteriors.
2. A document of n tokens and posteriors p, kept r times, brings r * n * p expected tokens to
   the domains.  Rates r >= 0 that bring the totals to the targets are found by projected
   gradient on the squared miss, weighted by the inverse of a Gram matrix of the domains, so that
   steps do not depend on how alike domains are.  A step first takes the Gram matrix of the
   documents that are not at their least rate, and that of all documents, which never overshoots,
   where this does not halve the miss.  Steps go on until the miss is under ``MISS`` of the
   tokens or no step lowers the squared miss by ``GAIN``; targets out of reach thus end near the
   least squares, not at them.  A miss that stays is warned of and reported by domain.  A step
   needs one row of totals; a document's rate is the same fold over the steps' residuals on every
   executor, so no state is stored.
3. A rate becomes copies: its whole part, and one more by a hash of the document against
   the rest.

Defined results: null text counts as empty; a document without words brings nothing, and its rate
stays at 1.  Labels that are null or meet no document do not count; a document with several
labels counts for the smallest domain name.  Documents most likely of a domain in ``whole`` keep
a rate of at least 1.  Without labels all documents are of the one
domain ``unknown``.  Targets are shares by domain name and are scaled to sum to one; a domain
without a target gets none.  Repeated rows get equal rates.  Texts are read whole, whatever their
length.  Other columns pass through.
"""

from __future__ import annotations

import warnings
from collections.abc import Collection, Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import words_of, written

#: Upper bin edges of the statistics; a value over the last edge has a bin of its own.
EDGES = {
    "words": (20, 50, 100, 200, 400, 800, 1600),
    "length": (2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 9.0),
    "symbols": (0.001, 0.01, 0.03, 0.1, 0.2, 0.3, 0.5),
    "capitals": (0.005, 0.01, 0.02, 0.04, 0.1, 0.3, 0.6),
    "distinct": (0.05, 0.1, 0.2, 0.4, 0.6, 0.8, 0.95),
}
#: The same for the share of words that mark a domain, one statistic per marked domain.
MARK_EDGES = (0.0, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1)
MISS = 1e-6
#: A step must lower the squared miss by this share; where none does, the rates are settled.
GAIN = 0.05
#: Share of the mean squared posterior mass added to the metric, so that domains which the
#: classifier cannot tell apart do not drive rates to extremes.
RIDGE = 0.02


def domain_of(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, domain): ``toxic``, ``good`` or ``low`` from the marks of the labelled table."""
    domain = (
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "low")
    )
    return labels.select(F.col(doc_id).alias("doc_id"), domain.alias("domain")).where(
        "domain is not null and doc_id is not null"
    ).groupBy("doc_id").agg(F.min("domain").alias("domain"))


def marker_words(rows: DataFrame, labelled: DataFrame, domain: str, most: int, sample: int) -> list[str]:
    """Words in lower case that tell ``domain`` from the rest, from about ``sample`` labelled rows a side."""
    sides = labelled.withColumn("_in", (F.col("domain") == domain))
    totals = {r["_in"]: r["n"] for r in sides.groupBy("_in").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return []
    share = F.when(F.col("_in"), sample / totals[True]).otherwise(sample / totals[False])
    drawn = sides.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    words = (
        # the sample is bounded, whatever the tables' sizes
        rows.join(F.broadcast(drawn), F.col("_id") == F.col("doc_id"))
        .select("_in", F.explode(F.array_distinct(words_of(F.lower("_text")))).alias("w"))
        .groupBy("w").agg(
            F.sum(F.col("_in").cast("int")).alias("a"), F.sum((~F.col("_in")).cast("int")).alias("b")
        )
        .where("a >= 5")
        .select("w", (F.log((F.col("a") + 1) / (F.col("b") + 1)) * F.sqrt("a")).alias("gain"))
        .where("gain > 3").orderBy(F.desc("gain"), "w").limit(most)
    )
    return [r["w"] for r in words.collect()]


def _statistics(rows: DataFrame, marks: list[list[str]]) -> DataFrame:
    """Rows with ``_n`` (tokens) and ``_bins``, one bin number per statistic."""
    words, rest = F.col("_words"), F.col("_rest")
    found = lambda m: F.size(F.filter(words, lambda w: F.lower(w).isin(*m))) if m else F.lit(0)
    marked = F.array(*[found(m) for m in marks])
    kept = rows.withColumn("_words", words_of(F.col("_text"))).withColumns({
        "_joined": F.array_join("_words", ""), "_kinds": F.size(F.array_distinct("_words")), "_marked": marked,
        "_n": F.size("_words").cast("long"),
    })
    kept = kept.withColumn("_rest", F.regexp_replace("_joined", r"[a-z]+", ""))
    per = lambda n, total: F.coalesce(n / F.nullif(total, F.lit(0)), F.lit(0.0))
    chars = F.length("_joined")
    left = lambda pattern: F.length(F.regexp_replace(rest, pattern, ""))
    values = {
        "words": F.col("_n"), "length": per(chars, F.col("_n")),
        "symbols": per(left(r"[\p{L}\p{N}.,;:'\-]"), chars), "capitals": per(left(r"[^\p{Lu}]"), chars),
        "distinct": per(F.col("_kinds"), F.col("_n")),
    }
    edges = [*EDGES.values(), *[MARK_EDGES] * len(marks)]
    values = [*values.values(), *[per(F.col("_marked")[i], F.col("_n")) for i in range(len(marks))]]
    kept = kept.withColumns({f"_v{i}": v.cast("double") for i, v in enumerate(values)})
    bins = [
        sum(((F.col(f"_v{i}") > float(e)).cast("int") for e in each), F.lit(0))
        for i, each in enumerate(edges)
    ]
    return kept.withColumn("_bins", F.array(*bins)).drop(
        "_words", "_joined", "_kinds", "_marked", "_rest", *[f"_v{i}" for i in range(len(values))]
    )


def _posteriors(stats: DataFrame, labelled: DataFrame, temper: float) -> tuple[DataFrame, list[str]]:
    """``stats`` with ``_p``, the posteriors in the order of the returned domains."""
    counted = (
        stats.join(labelled, F.col("_id") == F.col("doc_id"))
        .select("domain", F.posexplode("_bins").alias("stat", "bin"))
        .groupBy("domain", "stat", "bin").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    domains = sorted({r["domain"] for r in counted}) or ["unknown"]
    n_stats = 1 + max((r["stat"] for r in counted), default=-1)
    table = np.ones((n_stats, 8, len(domains)))
    for r in counted:
        table[r["stat"], r["bin"], domains.index(r["domain"])] += r["n"]
    sizes = table.sum(axis=1, keepdims=True)
    logs = np.log(table / sizes)
    prior = np.log(sizes[0, 0] / sizes[0, 0].sum()) if n_stats else np.zeros(1)
    score = []
    for k in range(len(domains)):
        total = F.lit(float(prior[k]))
        for s in range(n_stats):
            row = F.array(*[F.lit(float(v)) for v in logs[s, :, k]])
            total = total + temper * F.element_at(row, F.col("_bins")[s] + 1)
        score.append(total)
    scored = stats.withColumn("_scores", F.array(*score))
    scored = scored.withColumn(
        "_raised", F.transform("_scores", lambda v: F.exp(v - F.array_max("_scores")))
    )
    total = F.aggregate("_raised", F.lit(0.0), lambda a, v: a + v)
    scored = scored.withColumn("_total", total)
    return scored.withColumn("_p", F.transform("_raised", lambda v: v / F.col("_total"))).drop(
        "_scores", "_raised", "_total", "_bins"
    ), domains


def _least(floor: float, whole: Collection[str], domains: list[str]) -> Column:
    """The least rate of a document: at least 1 if it is most likely of a domain in ``whole``."""
    kept = [i + 1 for i, d in enumerate(domains) if d in whole]
    if not kept or floor >= 1:
        return F.lit(float(floor))
    likely = F.array_position("_p", F.array_max("_p"))
    return F.when(likely.isin(*kept), F.lit(1.0)).otherwise(F.lit(float(floor)))


def _rate(steps: list[np.ndarray], least: Column, k: int) -> Column:
    """The rate after the steps so far: a fold over literal residuals, one vector a step."""
    start = F.greatest(F.lit(1.0), least)
    if not steps:
        return F.when(F.col("_n") > 0, start).otherwise(F.lit(1.0))
    vectors = F.array(*[F.array(*[F.lit(float(v)) for v in step]) for step in steps])

    def move(rate: Column, vector: Column) -> Column:
        # a share of tokens times posteriors times residual; the weights hold all scales
        gain = sum((F.col("_p")[i] * vector[i] for i in range(k)), F.lit(0.0))
        return F.greatest(least, rate - gain)

    return F.when(F.col("_n") > 0, F.aggregate(vectors, start, move)).otherwise(F.lit(1.0))


def _totals(stats: DataFrame, rate: Column, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected tokens by domain at ``rate`` and at the least rates, and the Gram matrix of the
    documents over their least rate."""
    brought = lambda r, i: F.sum(F.col(r) * F.col("_n") * F.col("_p")[i])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    free = F.when(F.col("_r") > F.col("_least"), F.col("_n")).otherwise(0)
    row = stats.withColumn("_r", rate).agg(
        *[brought("_r", i).alias(f"t{i}") for i in range(k)],
        *[brought("_least", i).alias(f"f{i}") for i in range(k)],
        *[F.sum(free * F.col("_p")[i] * F.col("_p")[j]).alias(f"g{i}_{j}") for i, j in pairs],
    ).first()
    gram = np.zeros((k, k))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = row[f"g{i}_{j}"] or 0.0
    now, floors = (np.array([row[f"{c}{i}"] or 0.0 for i in range(k)]) for c in "tf")
    return now, floors, gram


def _inverse(gram: np.ndarray) -> np.ndarray:
    k = len(gram)
    return np.linalg.inv(gram + RIDGE * np.trace(gram) / k * np.eye(k))


def solve(
    stats: DataFrame, domains: list[str], targets: Mapping[str, float], floor: float, budget: float | None,
    whole: Collection[str] = (),
) -> tuple[Column, dict]:
    """The rate column over ``_n`` and ``_p``, and what it reaches.

    Steps are taken in the metric that gives each document its weight n, so a step changes
    rates by posteriors times residual whatever the document's length.
    """
    k = len(domains)
    share = np.array([max(0.0, float(targets.get(d, 0.0))) for d in domains])
    share = share / share.sum() if share.sum() > 0 else np.full(k, 1 / k)
    least = _least(floor, whole, domains)
    stats = stats.withColumn("_least", least)
    now, floors, free = _totals(stats, F.lit(1.0), k)
    if now.sum() == 0:
        return F.lit(1.0), {"domains": domains, "before": [0.0] * k, "wanted": [0.0] * k, "after": [0.0] * k, "rounds": 0}
    # as many tokens as there are, or the fewest in which the least rates of all documents fit
    fits = max((f / s for f, s in zip(floors, share, strict=True) if s > 0), default=0.0)
    wanted = share * (budget if budget is not None else max(now.sum(), fits))
    full = _totals(stats, F.col("_least") + 1.0, k)[2]  # all documents count as free
    plain = _inverse(full)
    steps: list[np.ndarray] = []
    reached, _, free = _totals(stats, _rate(steps, F.col("_least"), k), k)
    while np.abs(reached - wanted).sum() > MISS * wanted.sum():
        miss = reached - wanted
        height = miss @ plain @ miss
        tries = [plain @ miss]
        if 0 < np.trace(free) and not np.allclose(free, full):
            tries.insert(0, _inverse(free) @ miss)
        best = None
        for step in tries:
            after, _, over = _totals(stats, _rate([*steps, step], F.col("_least"), k), k)
            left = (after - wanted) @ plain @ (after - wanted)
            if best is None or left < best[0]:
                best = (left, step, after, over)
            if left <= height / 2:
                break
        if best[0] > (1 - GAIN) * height:
            break
        steps.append(best[1])
        reached, free = best[2], best[3]
    return _rate(steps, least, k), {
        "domains": domains, "before": now.tolist(), "wanted": wanted.tolist(), "after": reached.tolist(),
        "rounds": len(steps),
    }


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float],
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    floor: float = 0.0,
    whole: Collection[str] = (),
    budget: float | None = None,
    report: dict | None = None,
    carry: tuple[str, ...] = (),
    temper: float = 0.6,
    marks: int = 64,
    sample: int = 2_000,
) -> DataFrame:
    """A row per input row: the columns ``carry``, then doc_id, n_tokens, p_<domain>..., rate, copies.

    ``labels``: (doc_id, domain).  ``floor``: the least rate of all documents; ``whole``: domains
    whose documents keep a rate of at least 1.  ``budget``: expected tokens in all; by default as
    many as there are, or the fewest in which the least rates fit.  ``report`` gets the tokens by
    domain: before, wanted and after.  ``sample`` bounds the labelled rows from which marker words
    are drawn.
    """
    known = labels.select(F.col("doc_id"), F.col("domain").cast("string")).where(
        "doc_id is not null and domain is not null"
    ).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    source = docs.select(F.struct(F.lit(0).alias("_none"), *carry).alias("_more"), F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    sizes = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    largest = max(sizes, key=lambda d: (sizes[d], d), default=None)
    marked = [
        marker_words(source.select("_id", "_text"), known, d, marks, sample)
        for d in sorted(sizes) if d != largest
    ]
    measured = written(_statistics(source, marked).drop("_text"), "mix-statistics")
    scored, domains = _posteriors(measured, known, temper)
    posteriors = written(scored.select("_n", "_p"), "mix-posteriors")
    rate, reached = solve(posteriors, domains, targets, floor, budget, whole)
    off = sum(abs(a - w) for a, w in zip(reached["after"], reached["wanted"], strict=True))
    if off > 1e-3 * sum(reached["wanted"]):
        warnings.warn(f"targets are not reached: {reached}", stacklevel=2)
    if report is not None:
        report.update(reached)
    chance = F.pmod(F.xxhash64("_id", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    rated = scored.withColumn("_rate", rate)
    copies = F.floor("_rate") + (chance < F.col("_rate") - F.floor("_rate")).cast("long")
    return rated.select(
        *[F.col("_more")[c].alias(c) for c in carry],
        *([] if doc_id in carry else [F.col("_id").alias("doc_id")]),
        F.col("_n").alias("n_tokens"),
        *[F.col("_p")[i].alias(f"p_{d}") for i, d in enumerate(domains)],
        F.col("_rate").alias("rate"), copies.cast("long").alias("copies"),
    )
