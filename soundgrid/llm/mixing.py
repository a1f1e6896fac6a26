"""Mixing to target weights with soft domain membership.

A classifier (`subword`) learns domains from the labelled table (quality and toxic make the domain `q<quality>t<toxic>`) on a
bounded sample (at most LABELLED rows are looked up; `langid.bounded_sample` takes 1,500 of them, of texts of at most `langid.LONGEST` bytes)
and gives each document posterior domain probabilities.  Nonnegative document rates are then fitted so that the expected tokens of each
domain, sum over documents of rate * tokens * posterior, match the targets in least squares.

The fit is projected gradient descent with implicit steps.  In the metric that weighs a document by its tokens, the gradient of a
document's rate is posterior . r, where r are the K residuals.  A step moves every rate along it and projects, rate = clip(start - posterior . v,
0, most); an explicit step takes v = r / mu from the rates before, which needs tens of thousands of passes on ill-conditioned domains, an implicit
one takes the r that the moved rates leave.  That v is the root of mu v + target - reached(v), the gradient of a convex function of K
numbers, found by damped Newton steps: each pass is one aggregation to 1 + K + K(K+1)/2 sums, and no pass stores or shuffles documents.
mu falls tenfold until the residual is zero or moves no more, which is the optimum of least squares; of all optimal rates these are
the nearest to uniform ones.  The residual is a column of the result, and so is whether it is known to be the least.

Edge cases: a null or empty text has no tokens and the prior as posteriors; with no labelled document there is the one
domain `all`; an empty table gives an empty result; targets of domains that do not occur are dropped and the rest
rescaled; over DOMAINS domains are an error; repeated rows are rows of their own, and rows that share an id, or have none, are drawn alike.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import cut, gathered, text_or_empty, tune
from .langid import bounded_sample
from .subword import Model, train

#: Target share of tokens by domain.
WEIGHTS = {"q1t0": 0.75, "q0t0": 0.22, "q1t1": 0.01, "q0t1": 0.02}
#: Labelled rows whose texts are looked up for the sample.
LABELLED = 4000
DOMAINS = 32  # the passes sum K(K+1)/2 products
PASSES = 200
CLOSE = 1e-7  # of the budget


def fit_domains(docs: DataFrame, labels: DataFrame) -> Model:
    known = labels.where("doc_id is not null and quality is not null and toxic is not null").select(F.col("doc_id"), F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string")).alias("domain"))
    sizes = {r[0]: r[1] for r in known.groupBy("domain").count().limit(DOMAINS + 1).collect()}
    if len(sizes) > DOMAINS:
        raise ValueError(f"labels of over {DOMAINS} domains")
    if sizes:
        of = 1 << 20
        share = F.create_map(*(x for c, n in sizes.items() for x in (F.lit(c), F.lit(min(of, -(-of * (LABELLED // len(sizes)) // n))))))
        few = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(of)) < share[F.col("domain")]).orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(LABELLED)
        rows = docs.where("length(text) > 0").select("doc_id", "text").join(F.broadcast(few), "doc_id")  # few: at most LABELLED rows
        sample = bounded_sample(rows, "domain", "text", "doc_id", per_class=500, at_most=1500)
    else:
        sample = []
    if not sample:
        return Model(["all"], np.zeros((1 << 14, 1), np.float32), np.zeros(1), prior=np.ones(1))
    return train([t for t, _ in sample], [c for _, c in sample])


def posteriors(model: Model):
    @F.pandas_udf("tokens double, p array<double>")
    def run(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"tokens": [float(len(x.split())) for x in text], "p": [model.posterior(x).tolist() for x in text]})

    return lambda text: run(text_or_empty(text))


@dataclass
class Rates:
    """rate(p) = clip(start - p . step, 0, most)."""

    start: float
    step: list[float] = field(default_factory=list)
    most: float | None = None

    def unclipped(self, p: str | Column) -> Column:
        p = F.col(p) if isinstance(p, str) else p
        return sum((-p[i] * F.lit(float(v)) for i, v in enumerate(self.step)), F.lit(self.start))

    def column(self, p: str | Column) -> Column:
        top = F.lit(float("inf") if self.most is None else float(self.most))
        return F.greatest(F.lit(0.0), F.least(top, self.unclipped(p)))


def _pass(scored: DataFrame, rates: Rates, k: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Over all documents, weighted by tokens: the sum of the integrals of their clipped rates, the tokens reached by domain, and the second moments of the free ones."""
    rows = scored.select("tokens", "p", rates.unclipped("p").alias("s")).select("*", F.greatest(F.lit(0.0), F.least(F.lit(float("inf") if rates.most is None else rates.most), F.col("s"))).alias("w"))
    s, w = F.col("s"), F.col("w")
    held = F.when(s <= 0, 0.0).otherwise(w * s - w * w / 2)  # the integral of clip from 0 to s
    free = F.when((w > 0) & (w == s), F.col("tokens")).otherwise(0.0)
    domain = [F.col("p")[i] for i in range(k)]
    sums = [(i, j) for i in range(k) for j in range(i, k)]
    got = rows.agg(F.sum(F.col("tokens") * held), *(F.sum(F.col("tokens") * w * x) for x in domain), *(F.sum(free * domain[i] * domain[j]) for i, j in sums)).first()
    moments = np.zeros((k, k))
    for (i, j), v in zip(sums, got[1 + k :], strict=True):
        moments[i, j] = moments[j, i] = v
    return got[0], np.array(got[1 : 1 + k], dtype=float), moments


def fit_rates(scored: DataFrame, classes: list[str], weights: Mapping[str, float] = WEIGHTS, budget: float | None = None, most: float | None = None) -> tuple[Rates, dict]:
    """Rates for `scored` (tokens, p), and a report: tokens expected and wanted by domain, residual (its length as a share of the budget), passes, whether
    the residual is the least.  `budget`: tokens wanted in all; by default what the scarcest domain allows at rate 1."""
    k = len(classes)
    rows, *held = scored.agg(F.count("*"), *(F.coalesce(F.sum(F.col("tokens") * F.col("p")[i]), F.lit(0.0)) for i in range(k))).first()
    held, scored = np.array(held, dtype=float), gathered(scored, rows)
    share = np.array([weights.get(c, 0.0) for c in classes])
    share = share / share.sum() if share.sum() > 0 else np.full(k, 1 / k)
    share = np.where(held > 0, share, 0)
    if not share.sum():
        return Rates(1.0, [0.0] * k, most), {"expected": dict.fromkeys(classes, 0.0), "target": dict.fromkeys(classes, 0.0), "residual": 0.0, "passes": 0, "converged": True}
    share /= share.sum()
    if budget is None:
        budget = float(min(held[i] / share[i] for i in range(k) if share[i] > 0))
    target, total = share * budget, held.sum()
    start = float(budget / total)
    rates = Rates(start, [0.0] * k, most)
    at = np.zeros(k)
    inner, reached, moments = _pass(scored, rates, k)
    mu, passes, converged = 0.1 * total, 1, False
    least = float(np.linalg.norm(reached - target)) / budget
    stuck = False
    while passes < PASSES and not stuck:
        value = mu / 2 * at @ at + target @ at + inner
        while passes < PASSES:  # damped Newton steps to the implicit step of this mu
            slope = mu * at + target - reached
            if np.abs(slope).max() <= 1e-9 * budget:
                break
            way, length = np.linalg.solve(moments + mu * np.eye(k), -slope), 1.0
            while passes < PASSES:
                to = at + length * way
                tried = _pass(scored, Rates(start, to.tolist(), most), k)
                passes += 1
                now = mu / 2 * to @ to + target @ to + tried[0]
                if now <= value + 1e-4 * length * (slope @ way) + 1e-12 * abs(value) or length < 1e-6:
                    break
                length /= 2
            if length < 1e-6:  # no step lowers the function any more, though its slope is not zero
                stuck = True
                break
            at, value, (inner, reached, moments) = to, now, tried
        residual = float(np.linalg.norm(reached - target)) / budget
        if residual < CLOSE or (abs(least - residual) < CLOSE and not stuck):
            converged = True
            break
        least, mu = residual, mu / 10
    rates = Rates(start, at.tolist(), most)
    named = lambda x: dict(zip(classes, x.tolist(), strict=True))
    return rates, {"expected": named(reached), "target": named(target), "residual": float(np.linalg.norm(reached - target)) / budget, "passes": passes, "converged": converged}


def copies(rate: Column, doc_id: Column) -> Column:
    """Whole copies for a rate: its floor, and one more with the rest as probability, drawn by a hash of the id."""
    draw = F.pmod(F.xxhash64(doc_id, F.lit(29)), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + draw).cast("long")


def mix(docs: DataFrame, labels: DataFrame, weights: Mapping[str, float] = WEIGHTS, budget: float | None = None, most: float | None = None) -> DataFrame:
    """doc_id, tokens, posterior (map of domain to probability), rate, copies, and the fit's residual and converged for every row."""
    tune(docs.sparkSession)
    model = fit_domains(docs, labels)
    scored = cut(docs.select("doc_id", posteriors(model)("text").alias("s")).select("doc_id", "s.tokens", "s.p"))
    rates, told = fit_rates(scored, model.classes, weights, budget, most)
    rate = rates.column("p")
    return scored.select("doc_id", F.col("tokens").cast("long").alias("tokens"), F.map_from_arrays(F.array(*map(F.lit, model.classes)), "p").alias("posterior"), rate.alias("rate"), copies(rate, F.col("doc_id")).alias("copies"), F.lit(told["residual"]).alias("residual"), F.lit(told["converged"]).alias("converged"))


def keep_mixed(docs: DataFrame, labels: DataFrame, weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """Rows of `docs` drawn at the fitted rates (at most 1), with its columns; one draw decides for all rows of an id.  Posteriors are computed again in the pass that filters, which avoids a shuffle of the texts."""
    tune(docs.sparkSession)
    model = fit_domains(docs, labels)
    scored = cut(docs.select(posteriors(model)("text").alias("s")).select("s.tokens", "s.p"))
    rates, _ = fit_rates(scored, model.classes, weights, most=1.0)
    names = docs.columns
    made = docs.select("*", posteriors(model)("text").alias("mixing_posterior_of_row"))
    kept = made.where(copies(rates.column(F.col("mixing_posterior_of_row")["p"]), F.col("doc_id")) > 0)
    return kept.select(*(f"`{c}`" for c in names))
