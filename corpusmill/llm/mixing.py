"""Mixing sources to target weights by soft membership.

A labelled table gives documents of known domain. From them a classifier is learnt: per domain, a lexicon
of words with the highest log-odds, and Gaussian naive Bayes over a few numeric features (the lexicons'
rates among them). It gives each document a posterior over the domains.

Rates r >= 0 are then fitted: with t tokens and posteriors p, the expected tokens of domain k are
S_k = sum(r * t * p_k), and the least squares problem is minimise sum_k (S_k - T_k)^2 / (e * w_k) + sum(t * (r - 1)^2),
where w_k = sum(t * p_k^2) evens out the domains' curvatures and the second term picks the rates nearest to 1.
Gradient steps in the metric of t move a document's rate by sum_k p_k l_k, so after any of them r = max(0, 1 + sum_k p_k l_k):
steps add up in l, a number for each domain, and the projection comes last. A step is scaled by the curvature of
the documents whose rate isn't 0 (plain steps take hundreds, or never arrive, where posteriors overlap), with a
line search on the dual, which is convex. It ends within the tolerance of the targets or else, e having been
lowered through `RIDGES`, at a point proven stationary; what is then missing is returned and warned about.
Each step is one aggregation of a narrow table that holds a row for each document; only domain totals come to
the driver.

Everything on the data is DataFrame operations. The classifier is fitted on `sample_rows` labelled rows,
the first by a hash of doc_id.

Defined cases: null and empty texts have no tokens, whatever their posterior, so any rate would do: they
keep rate 1; domains without labelled rows have posterior 0; without any labelled row posteriors are
equal; repeated rows count each; a null doc_id is kept.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import whole_text, written

DOMAINS = ("clean", "low", "toxic")
#: Shares of the tokens.
TARGETS = {"clean": 0.88, "low": 0.04, "toxic": 0.08}
#: The weights e of staying near 1 against meeting the targets, each tried where the one before doesn't meet them.
RIDGES = (1e-3, 1e-6, 1e-8)
_MARK, _CAPITAL = r"[!-/:-@\[-`{-~]", "[A-ZÀ-ÖØ-Þ]"


def measured(docs: DataFrame, *more: str) -> DataFrame:
    """The columns in more, and the texts' words (lower-cased, without ASCII punctuation) and shares of signs.

    A token is what then stands between spaces, tabs or line feeds; marks alone are none.
    """
    texts = docs.select(*more, whole_text().alias("text"))
    bare = texts.select(*more, "text", F.regexp_replace(F.lower("text"), _MARK, "").alias("bare"))
    chars = F.greatest(F.length("text"), F.lit(1)).cast("double")
    words = F.array_remove(F.split(F.replace(F.replace("bare", F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" ")), " "), "")
    return bare.select(*more, words.alias("words"), F.sqrt(F.regexp_count("text", F.lit(_CAPITAL)) / chars).alias("capital"), F.sqrt((F.length("text") - F.length("bare")) / chars).alias("mark"))


def domains_of(labels: DataFrame) -> DataFrame:
    """doc_id and domain of the labelled documents; of several labels the highest marks count."""
    rows = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    domain = F.when(F.col("t") == 1, "toxic").when(F.col("q") == 0, "low").when(F.col("q") == 1, "clean")
    return rows.select("doc_id", domain.alias("domain")).where(F.col("domain").isNotNull())


def lexicons(sample: DataFrame, terms: int) -> list[list[str]]:
    """Per domain the words whose presence has the highest log-odds, weighted by how sure they are."""
    words = sample.select("domain", F.explode(F.array_distinct("words")).alias("word")).where(F.col("word").rlike(r"^\p{L}{3,20}$"))
    counts = words.groupBy("word").pivot("domain", list(DOMAINS)).count().fillna(0)
    sizes = {r.domain: r["count"] for r in sample.groupBy("domain").count().collect()}
    scores = []
    for d in DOMAINS:
        rest = reduce(lambda a, b: a + b, [F.col(x) for x in DOMAINS if x != d])
        n, m = sizes.get(d, 0), sum(v for k, v in sizes.items() if k != d)
        odds = F.log((F.col(d) + 0.5) / (n - F.col(d) + 0.5)) - F.log((rest + 0.5) / (m - rest + 0.5))
        error = F.sqrt(1 / (F.col(d) + 0.5) + 1 / (rest + 0.5))
        scores.append(F.struct(F.lit(d).alias("domain"), (odds / error).alias("z")))
    ranked = counts.select("word", F.explode(F.array(*scores)).alias("s")).select("word", "s.domain", "s.z").where("z > 3")
    best = Window.partitionBy("domain").orderBy(F.desc("z"), "word")
    rows = ranked.withColumn("place", F.row_number().over(best)).where(F.col("place") <= terms).collect()
    return [sorted(r.word for r in rows if r.domain == d) for d in DOMAINS]


def features(rows: DataFrame, lexicon: list[list[str]], *more: str) -> tuple[DataFrame, list[str]]:
    """The columns in more, n_tokens and the features of measured rows; and the features' names."""
    distinct = rows.select(*more, F.size("words").cast("bigint").alias("n_tokens"), F.array_distinct("words").alias("own"), "capital", "mark")
    found = [F.log1p(F.size(F.array_intersect("own", F.array(*map(F.lit, w)))).cast("double")) if w else F.lit(0.0) for w in lexicon]
    different = F.log(F.size("own") / F.greatest("n_tokens", F.lit(1)) + 0.01)
    names = [f"x{i}" for i in range(len(lexicon) + 3)]
    return distinct.select(*more, "n_tokens", *(c.alias(n) for c, n in zip([*found, F.col("capital"), F.col("mark"), different], names, strict=True))), names


def posterior(x: list[str], rows: dict[str, dict]) -> Column:
    """array<double> over DOMAINS from the per-domain sizes, means and variances."""
    total = sum(r["n"] for r in rows.values())
    if not total:
        return F.array(*[F.lit(1 / len(DOMAINS))] * len(DOMAINS))
    # Shrink each variance towards the pooled one, so that a feature a class never shows stays finite.
    pooled = [max(1e-4, sum(r["n"] * r[f"v_{c}"] for r in rows.values()) / total) for c in x]
    logs = []
    for d in DOMAINS:
        r = rows.get(d)
        if not r:
            logs.append(F.lit(-1e300))
            continue
        log = F.lit(math.log(r["n"] / total))
        for c, p in zip(x, pooled, strict=True):
            v = 0.8 * r[f"v_{c}"] + 0.2 * p
            log = log - ((F.col(c) - r[f"m_{c}"]) * (F.col(c) - r[f"m_{c}"]) / v + math.log(v)) / 2
        logs.append(log)
    return F.array(*logs)


def soft_members(docs: DataFrame, labels: DataFrame, sample_rows: int = 4000, terms: int = 16, more: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens and p (the posterior over DOMAINS) of every row, with the columns in more, written to the shared folder."""
    named = domains_of(labels)
    chosen = named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # The row's own text has to be there to be measured; what is sampled is a bounded number of labelled ids.
    sample = written(measured(docs.join(F.broadcast(chosen), "doc_id"), "domain"), "sample")
    lexicon = lexicons(sample, terms)
    shown, names = features(sample, lexicon, "domain")
    stats = shown.groupBy("domain").agg(F.count("*").alias("n"), *(f(n).alias(f"{k}_{n}") for n in names for f, k in ((F.avg, "m"), (F.var_pop, "v"))))
    rows = {r.domain: r.asDict() for r in stats.collect()}
    every, _ = features(measured(docs, "doc_id", *more), lexicon, "doc_id", *more)
    own = ("doc_id", "n_tokens", *more)
    logs = every.select(*own, posterior(names, rows).alias("g"))
    if rows:
        odds = logs.select(*own, F.transform("g", lambda v: F.exp(v - F.array_max("g"))).alias("e"))
        logs = odds.select(*own, F.transform("e", lambda v: v / F.aggregate("e", F.lit(0.0), lambda a, b: a + b)).alias("g"))
    return written(logs.select(*own, F.col("g").alias("p")), "members")


def rate_of(l: np.ndarray) -> Column:
    """The rate of a document after steps that add up to l."""
    return F.greatest(F.lit(0.0), reduce(lambda a, b: a + b, [F.col("p")[k] * float(l[k]) for k in range(len(DOMAINS))], F.lit(1.0)))


def multipliers(evaluate: Callable[[np.ndarray], tuple], start: tuple, target: np.ndarray, budget: float, tolerance: float, most: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """l and the reached totals. evaluate(l): sum(t r^2), the totals, and the curvature of rows with r > 0; start: the same at 0.

    Domains that no document can belong to are left out.
    """
    l, used, done = np.zeros(len(target)), np.diag(start[2]) > 0, 0
    w, near = np.diag(start[2])[used], tolerance * np.maximum(target, 1e-2 * budget)
    square, reached, curve = start
    for e in RIDGES:
        while True:
            if (np.abs(reached - target) <= near)[used].all():
                return l, reached
            slope = (reached - target)[used] + e * w * l[used]
            # In units in which the diagonal is 1, so that a rare domain counts as any other.
            unit = 1 / np.sqrt(np.diag(curve)[used] + e * w)
            matrix = (curve[np.ix_(used, used)] + np.diag(e * w)) * np.outer(unit, unit)
            step = unit * np.linalg.solve(matrix + 1e-13 * np.eye(len(w)), slope * unit)
            gain, value = float(slope @ step), square / 2 - l @ target + e / 2 * float(w @ l[used] ** 2)
            if gain <= 1e-12 * budget:
                break
            size = 1.0
            while True:
                if done == most:
                    raise RuntimeError(f"the rates didn't settle in {most} steps: totals {reached.tolist()} for {target.tolist()}")
                tried = l.copy()
                tried[used] -= size * step
                square, reached, curve = evaluate(tried)
                done += 1
                if square / 2 - tried @ target + e / 2 * float(w @ tried[used] ** 2) <= value - 1e-4 * size * gain + 1e-13 * abs(value):
                    break
                size /= 2
            l = tried
    return l, reached


def fit_rates(members: DataFrame, weights: dict[str, float], grow: bool = False, tolerance: float = 1e-3, budget: float = 1.0) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """members with the column rate, the targets, and the reached totals.

    The budget is so many times the tokens there are or, with grow, the least one for which no domain must shrink.
    """
    n = len(DOMAINS)
    p = [F.col("p")[k] for k in range(n)]
    t = F.col("n_tokens").cast("double")
    pairs = [(k, m) for k in range(n) for m in range(k, n)]
    rows = members.select(t.alias("t"), "p")

    def evaluate(l: np.ndarray) -> tuple:
        r, on = F.col("r"), F.when(F.col("r") > 0, F.col("t")).otherwise(0.0)
        sums = rows.select("t", *(p[k].alias(f"p{k}") for k in range(n)), rate_of(l).alias("r"))
        got = sums.agg(F.sum(F.col("t") * r * r).alias("q"), *(F.sum(r * F.col("t") * F.col(f"p{k}")).alias(f"s{k}") for k in range(n)), *(F.sum(on * F.col(f"p{k}") * F.col(f"p{m}")).alias(f"g{k}{m}") for k, m in pairs)).first()
        curve = np.zeros((n, n))
        for k, m in pairs:
            curve[k, m] = curve[m, k] = got[f"g{k}{m}"] or 0.0
        return got["q"] or 0.0, np.array([got[f"s{k}"] or 0.0 for k in range(n)]), curve

    start = evaluate(np.zeros(n))
    now = start[1]
    share = np.array([max(0.0, weights.get(d, 0.0)) for d in DOMAINS])
    share = share / share.sum()
    total = max([now[k] / share[k] for k in range(n) if share[k] > 0]) if grow else budget * now.sum()
    target = share * total
    if not now.sum():
        return members.withColumn("rate", F.lit(1.0)), target, now
    l, reached = multipliers(evaluate, start, target, total, tolerance)
    if (np.abs(reached - target) > tolerance * np.maximum(target, 1e-2 * total)).any():
        warnings.warn(f"no rates meet the targets: of {total:.0f} tokens {dict(zip(DOMAINS, (reached / total).round(4).tolist(), strict=True))} for {dict(zip(DOMAINS, share.round(4).tolist(), strict=True))}", stacklevel=2)
    return members.withColumn("rate", rate_of(l)), target, reached


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, grow: bool = False, **options) -> DataFrame:
    """doc_id, n_tokens, the posterior of each domain and the rate of every document.

    The column missed tells, the same in every row, how far the worst domain ends from its target, as a share of the token budget.
    """
    members = soft_members(docs, labels, **options)
    rated, target, reached = fit_rates(members, weights or TARGETS, grow)
    missed = float(np.abs(reached - target).max() / target.sum()) if target.sum() else 0.0
    return rated.select("doc_id", "n_tokens", *(F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(DOMAINS)), F.when(F.col("n_tokens") == 0, 1.0).otherwise(F.col("rate")).alias("rate"), F.lit(missed).alias("missed"))


def remix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, seed: int = 7, budget: float = 1.0, **options) -> DataFrame:
    """The rows of docs, each as often as its rate says, for a token budget of so many times the tokens there are.

    A rate's fraction is settled by a hash of doc_id and text, so that a rerun repeats the same rows; rows that agree
    in both go the same way. Rows without tokens keep rate 1.
    """
    packed = docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    members = soft_members(packed, labels, more=("row",), **options)
    rated = fit_rates(members, weights or TARGETS, budget=budget)[0]
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("row.doc_id"), F.col("row.text")), F.lit(1 << 20)) / float(1 << 20)
    times = F.when(F.col("n_tokens") == 0, 1).otherwise(F.floor(F.col("rate") + draw)).cast("int")
    return rated.select("row", F.explode(F.array_repeat(F.lit(1), times))).select("row.*")
