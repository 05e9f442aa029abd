"""Soft-membership mixing: document rates that bring expected domain totals to target shares.

A model of which word beginnings stand in labelled rows gives each document
posterior probabilities of the domains. Rates (expected copies)
are fitted by projected-gradient least squares: with tokens t, posteriors p and
rates r, the expected total of domain d is the sum of r * t * p[d]. Each step
aggregates those few totals over all documents, and moves every rate along its
posteriors against the residual, cut at zero. The residual is weighted by the
inverse of the sum of t * p * p', which makes the step length one. Only built-in
functions touch documents; the driver sees totals by domain.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .phases import Phases, computed_once

#: Characters of a word that count; inflected forms share them.
STEM = 5
SEPARATORS = " \t\n\x0b\f\r"
HEATS = (0.5, 1, 2, 4, 8, 16, 32)


def words_of(text: Column) -> Column:
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SEPARATORS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def beginnings(words: Column) -> Column:
    """The lower-cased beginnings of words, repeats included."""
    return F.transform(words, lambda w: F.lower(F.substring(w, 1, STEM)))


def stems(words: Column) -> Column:
    """The distinct lower-cased beginnings of words."""
    return F.array_distinct(beginnings(words))


@dataclass(frozen=True)
class Model:
    """Domains, log priors, and for each domain but the first, against the first: what a text without any
    telling stem scores, and what each telling stem adds."""

    domains: tuple[str, ...]
    priors: tuple[float, ...]
    bare: tuple[float, ...]
    odds: tuple[dict[str, float], ...]
    heat: float = 1.0


def fit_model(docs: DataFrame, labelled: DataFrame, per_domain: int = 2000, domains: int = 16, vocabulary: int = 512, certainty: float = 5.0) -> Model | None:
    """A model of ``labelled`` (doc_id, domain), or None if it has no rows with text.

    Bounds of the sample: the ``domains`` most frequent domains, about
    ``per_domain`` rows of each, drawn by the hash of doc_id, and for each domain
    the ``vocabulary`` stems whose share of rows differs most from the first
    domain's, by ``certainty`` standard errors or more.
    """
    phases = Phases(docs.sparkSession, "mixing-model")
    marks = labelled.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    counts = marks.groupBy("domain").count().orderBy(F.desc("count"), "domain").limit(domains).collect()
    if not counts:
        return None
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["domain"], min(1.0, per_domain / r["count"]))])
    draw = F.expr("pmod(xxhash64(doc_id, 17), 1000003)") / 1000003
    chosen = marks.where(draw < F.coalesce(F.try_element_at(share, F.col("domain")), F.lit(0.0)))
    chosen = F.broadcast(chosen.limit(2 * per_domain * domains))  # at most so many ids are sent
    sample = docs.select("doc_id", "text").join(chosen, "doc_id").select("domain", stems(words_of(F.col("text"))).alias("stems"))
    # the filter must not move below the join, or the stems of all documents are made for it
    sample = phases.land(computed_once(sample, "stems").where("size(stems) > 0"), "sample")
    rows = {r["domain"]: r["count"] for r in sample.groupBy("domain").count().collect()}
    if not rows:
        return None
    names = tuple(sorted(rows))
    held = sample.select("domain", F.explode("stems").alias("stem")).groupBy("stem")
    held = phases.land(held.agg(*[F.count_if(F.col("domain") == d).alias(f"n{k}") for k, d in enumerate(names)]), "held")
    share_of = lambda k: (F.col(f"n{k}") + 0.5) / (rows[names[k]] + 2)
    odds, bare = [], []
    for k in range(1, len(names)):
        value = F.log(share_of(k)) - F.log(share_of(0))
        absent = F.log(1 - share_of(k)) - F.log(1 - share_of(0))
        spread = sum((share_of(i) * (1 - share_of(i)) / rows[names[i]] for i in (0, k)), F.lit(0.0))
        telling = held.select("stem", value.alias("value"), absent.alias("absent"), (F.abs(share_of(k) - share_of(0)) / F.sqrt(spread)).alias("z"))
        top = telling.where(F.col("z") >= certainty).orderBy(F.desc("z"), "stem").limit(vocabulary).collect()
        odds.append({r["stem"]: r["value"] - r["absent"] for r in top})
        bare.append(math.fsum(r["absent"] for r in top))
    size = {r["domain"]: r["count"] for r in counts}
    priors = tuple(math.log(size[d] / sum(size[n] for n in names)) for d in names)
    scored = phases.land(sample.select("domain", scores(Model(names, priors, tuple(bare), tuple(odds)), F.col("stems")).alias("s")), "scored")
    # the sample has its own shares of the domains, so its calibration takes them as priors
    own = tuple(math.log(rows[d] / sum(rows.values())) for d in names)
    losses = [F.avg(-F.log(F.greatest(_of(names, posteriors(Model(names, own, tuple(bare), tuple(odds), h), F.col("s"))), F.lit(1e-12)))) for h in HEATS]
    found = scored.agg(*[x.alias(f"h{i}") for i, x in enumerate(losses)]).first()
    return Model(names, priors, tuple(bare), tuple(odds), float(HEATS[int(np.argmin(list(found)))]))


def _of(domains: tuple[str, ...], p: Column) -> Column:
    return F.get(p, F.array_position(F.array(*map(F.lit, domains)), F.col("domain")).cast("int") - 1)


def scores(model: Model, found: Column) -> Column:
    """Log odds of a text by its distinct stems, for each domain but the first."""

    def summed(bare: float, odds: dict[str, float]) -> Column:
        if not odds:
            return F.lit(bare)
        known = F.array_intersect(found, F.array(*map(F.lit, odds)))
        table = F.create_map(*[F.lit(v) for pair in odds.items() for v in pair])
        return F.aggregate(known, F.lit(bare), lambda s, w: s + F.element_at(table, w))

    return F.array(*map(summed, model.bare, model.odds)).cast("array<double>")


def posteriors(model: Model, s: Column) -> Column:
    """Domain probabilities in the model's order; without words they are the priors."""
    logits = [F.lit(model.priors[0])] + [F.lit(p) + F.get(s, k) / model.heat for k, p in enumerate(model.priors[1:])]
    top = F.greatest(*logits) if len(logits) > 1 else logits[0]
    parts = [F.exp(x - top) for x in logits]
    total = sum(parts[1:], parts[0])
    return F.array(*[x / total for x in parts])


def with_posteriors(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``__m_tokens`` (words, long) and ``__m_p``."""
    out = docs.withColumn("__m_words", words_of(F.col("text")))
    telling = sorted({w for odds in model.odds for w in odds})
    # few of a text's stems tell anything: these are picked first, which also drops repeats
    picked = F.array_intersect(beginnings(F.col("__m_words")), F.array(*map(F.lit, telling)).cast("array<string>"))
    out = out.withColumn("__m_tokens", F.size("__m_words").cast("long")).withColumn("__m_stems", picked)
    out = out.drop("__m_words").withColumn("__m_s", scores(model, F.col("__m_stems"))).drop("__m_stems")
    return out.withColumn("__m_p", posteriors(model, F.col("__m_s"))).drop("__m_s")


def rate_of(moves: list[np.ndarray], p: Column) -> Column:
    """The rate after all moves: from one, each step along the posteriors, cut at zero."""
    rate = F.lit(1.0)
    for move in moves:
        along = sum((F.get(p, k) * float(v) for k, v in enumerate(move)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - along)
    return rate


def fit_rates(docs: DataFrame, domains: tuple[str, ...], shares: dict[str, float], anchor: str, tolerance: float = 1e-4, steps: int = 25) -> list[np.ndarray]:
    """Moves of the projected gradient for ``docs`` with ``__m_tokens`` and ``__m_p``.

    Targets are ``shares`` of a total at which ``anchor`` keeps its expected
    tokens; domains without a share get none of them, and an anchor without
    tokens leaves all rates at one. Ends when the residual is below
    ``tolerance`` of all tokens, or after ``steps`` passes.
    """
    k = len(domains)
    t = F.col("__m_tokens").cast("double")
    p = [F.get("__m_p", i) for i in range(k)]
    sums = docs.agg(F.sum(t), *[F.sum(t * x) for x in p], *[F.sum(t * a * b) for a in p for b in p]).first()
    if not sums[0]:
        return []
    total, means = sums[0], np.array(sums[1 : k + 1]) / sums[0]
    gram = np.array(sums[k + 1 :]).reshape(k, k) / total
    if anchor not in domains or means[domains.index(anchor)] <= 0 or not shares.get(anchor):
        return []
    wanted = np.array([shares.get(d, 0.0) for d in domains])
    wanted = wanted / wanted.sum()
    at = domains.index(anchor)
    target = wanted * (means[at] / wanted[at])
    weight = np.linalg.pinv(gram, rcond=1e-9, hermitian=True)
    moves, now = [], means
    for _ in range(steps):
        residual = now - target
        if np.abs(residual).sum() < tolerance:
            break
        moves.append(weight @ residual)
        rate = rate_of(moves, F.col("__m_p"))
        now = np.array(docs.agg(*[F.sum(rate * t * x) for x in p]).first()) / total
    return moves


def rated(docs: DataFrame, labelled: DataFrame, shares: dict[str, float], anchor: str, phases: Phases, **bounds) -> tuple[DataFrame, tuple[str, ...]]:
    """``docs`` with ``__m_tokens``, ``__m_p`` and ``__m_rate``, and the domains in the order of ``__m_p``.

    ``labelled`` has doc_id and domain; a repeated doc_id counts once, with its
    least domain. Null and empty texts have no tokens, and their priors as
    posteriors. Without usable labels all rates are one and ``__m_p`` is empty.
    Repeated rows get equal rates, an empty table gives an empty one, and other
    columns pass through.
    """
    model = fit_model(docs, labelled, **bounds)
    if model is None:
        none = docs.withColumn("__m_tokens", F.size(words_of(F.col("text"))).cast("long"))
        return none.withColumn("__m_p", F.array().cast("array<double>")).withColumn("__m_rate", F.lit(1.0)), ()
    scored = phases.land(with_posteriors(docs, model), "posteriors")
    moves = fit_rates(scored, model.domains, shares, anchor)
    return scored.withColumn("__m_rate", rate_of(moves, F.col("__m_p"))), model.domains


def mixed(docs: DataFrame, labelled: DataFrame, shares: dict[str, float], anchor: str, **bounds) -> DataFrame:
    """Each row of ``docs`` as often as its rate says, with its own columns only.

    The whole part of the rate is certain; for the rest a hash of doc_id and text
    decides, so a rerun gives the same rows. See ``rated`` for odd input.
    """
    out, _ = rated(docs, labelled, shares, anchor, Phases(docs.sparkSession, "mixing"), **bounds)
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(19)), F.lit(1 << 30)) / (1 << 30)
    whole = F.floor("__m_rate")
    copies = (whole + (draw < F.col("__m_rate") - whole).cast("long")).cast("int")
    names = [F.col(f"`{c}`") for c in docs.columns]
    return out.withColumn("__m_copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*names)


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of a label table: toxic, else low or good by quality; rows without a label go."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain")).where("domain is not null")


#: Default targets: shares of expected tokens by domain.
SHARES = {"good": 0.92, "low": 0.06, "toxic": 0.02}
