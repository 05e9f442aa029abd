"""URL filter: rules for hosts and paths, and a character language model for all other URLs.

URLs that rules accept and reject train two smoothed variable-order Markov
models. Both share their contexts: the runs of up to ``order`` characters before
a character that are there often enough. A context's suffixes and the contexts
that lead to it are at least as frequent, so the most frequent contexts are the
states of an automaton, and two arrays of bounded size say for each state and
character what it adds to the log-likelihood difference and which state follows.
A URL is one fold over its characters, in built-in functions only. Where a longer
context than the automaton's is known, a join of runs of characters adds what it
says beyond that, so the automaton's size changes no score. The difference is
divided by the number of characters and calibrated on labelled URLs that trained
neither model.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .phases import Phases, computed_once

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Symbols: U+0020 to U+007E by their place from 1, any other character 0, the end last; PAD stands before the first.
SYMBOLS, END, PAD = 97, 96, "\x02"
OTHER, LAST = "\x1f", "\x7f"
#: Bins of a unit of normalised difference in calibration, and the largest size that counts there.
BINS, WIDEST = 64, 32
UNIT = 1_000_000
#: One in so many labelled URLs calibrates, and trains no model.
HELD = 5
#: Contexts of the automaton, the most frequent ones; all others take part by a join.
STATES = 1024


@dataclass(frozen=True)
class Rule:
    allow: bool
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (Rule(False, "net", "/"), Rule(True, "example.net", "/en/"), Rule(False, "example.com", "/de/"), Rule(True, "org", "/fr/"))


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(text, allow) of the longest rule that fits, or null; of two as long, the earlier one."""
    chain = F.lit(None)
    for rule in sorted(rules, key=lambda r: len(r.text)) if rules else ():
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        chain = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.allow).alias("allow"))).otherwise(chain)
    return chain.cast("struct<text: string, allow: boolean>")


def plain(url: Column) -> Column:
    """The URL as the models read it: the host in lower case, characters beyond U+0020 to U+007E as one symbol."""
    at = F.instr(url, "://")
    start = F.when(at > 0, at + 2).otherwise(F.lit(0))
    host = F.regexp_extract(F.substring(url, start + 1, F.length(url)), "^[^/?#]*", 0)
    lowered = F.concat(F.substring(url, F.lit(1), start), F.translate(host, UPPER, LOWER), F.substring(url, start + F.length(host) + 1, F.length(url)))
    return F.regexp_replace(F.coalesce(F.when(at > 0, lowered).otherwise(url), F.lit("")), r"[^\x20-\x7E]", OTHER)


def characters(text: Column) -> Column:
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(text, ""))


def symbol(character: str) -> int:
    return ord(character) - 31 if character != LAST else END


def grams_in(texts: DataFrame, order: int, keep: str) -> DataFrame:
    """(``keep``, gram): the run of ``order`` + 1 symbols that ends at each character of ``text`` and at its end."""
    padded = F.concat(F.lit(PAD * order), "text", F.lit(LAST))
    # lists of single characters put together, as cutting a long text at each place would read it again each time
    chars = texts.select(keep, F.split(padded, "").alias("chars"))
    chars = computed_once(chars, "chars")
    grams = F.zip_with("chars", F.slice("chars", 2, F.size("chars")), lambda a, b: F.concat(a, b))
    for k in range(2, order + 1):
        grams = F.zip_with(grams, F.slice("chars", k + 1, F.size("chars")), lambda a, b: F.concat(a, b))
    return chars.select(keep, F.explode(grams if order else F.col("chars")).alias("gram")).where(F.col("gram").isNotNull())


def gram_counts(labelled: DataFrame, order: int) -> DataFrame:
    """(gram, good, bad): how often each run of ``order`` + 1 symbols ends at a character of accepted and rejected URLs."""
    whole = grams_in(labelled, order, "allow")
    return whole.groupBy("gram").agg(F.count_if("allow").alias("good"), F.count_if(~F.col("allow")).alias("bad"))


@dataclass(frozen=True)
class Automaton:
    """State 0 is the empty context. Cells are state * SYMBOLS + symbol; scores are in 1 / UNIT, so their sums are exact."""

    start: int
    score: list[int]
    follow: list[int]


def retained(grams: DataFrame, order: int, contexts: int | None, least: int, phases: Phases) -> tuple[DataFrame, DataFrame]:
    """Landed (context, last, good, bad) and (context, n, good_n, good_kinds, bad_n, bad_kinds) of all contexts with ``least`` occurrences.

    ``last`` is the symbol that follows. If ``contexts`` is given, that many of the most frequent at most.
    """
    context = [F.substring("gram", F.lit(order - k + 1), F.lit(k)) for k in range(order + 1)]
    long = grams.select(F.explode(F.array(*context)).alias("context"), F.substring("gram", order + 1, 1).alias("last"), "good", "bad")
    cells = phases.land(long.groupBy("context", "last").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), "all-cells")
    sums = [f(c).alias(c + name) for c in ("good", "bad") for name, f in (("_n", F.sum), ("_kinds", lambda c: F.count_if(F.col(c) > 0)))]
    kept = cells.groupBy("context").agg(F.sum(F.col("good") + F.col("bad")).alias("n"), *sums).where((F.col("n") >= least) | (F.col("context") == ""))
    kept = phases.land(kept if contexts is None else most_frequent(kept, contexts), "contexts")
    own = phases.land(cells.join(kept.select("context"), "context", "left_semi"), "cells")
    phases.drop(cells)
    return own, kept


def most_frequent(kept: DataFrame, n: int) -> DataFrame:
    # a suffix is as frequent or more, and shorter, so it comes first and the set has the suffixes of all it holds
    return kept.orderBy(F.desc("n"), F.length("context"), "context").limit(n)


def beyond(wanted: DataFrame, cells: DataFrame, kept: DataFrame, states: DataFrame, order: int) -> DataFrame:
    """(gram, more) for the grams whose longest context is kept, but no state of the automaton: what it adds to the automaton's score.

    Chances follow ``automaton``, a context length at a time.
    """
    kept = kept.join(F.broadcast(states.select("context", F.lit(True).alias("state"))), "context", "left")
    sides, even = ("good", "bad"), F.lit(1.0 / SYMBOLS)
    found = wanted.select("gram", F.substring("gram", order + 1, 1).alias("last"), *[even.alias(s + p) for s in sides for p in ("_p", "_state")], F.lit(False).alias("more"))
    for k in range(order + 1):
        found = found.withColumn("context", F.substring("gram", F.lit(order - k + 1), F.lit(k)))
        size = F.length("context") == k
        found = found.join(kept.where(size), "context", "left").join(cells.where(size), ["context", "last"], "left")
        for s in sides:
            n, kinds, p = F.col(s + "_n"), F.col(s + "_kinds"), F.col(s + "_p")
            chance = (F.coalesce(F.col(s), F.lit(0)) + kinds * p) * (F.lit(1.0) / (n + kinds))
            found = found.withColumn(s + "_p", F.when(kinds > 0, chance).otherwise(p))
            found = found.withColumn(s + "_state", F.when(F.col("state"), F.col(s + "_p")).otherwise(F.col(s + "_state")))
        more = F.when(F.col("n").isNotNull(), F.col("state").isNull()).otherwise(F.col("more"))
        found = found.withColumn("more", more).select("gram", "last", *[s + p for s in sides for p in ("_p", "_state")], "more")
    score = lambda p: F.rint((F.log("good" + p) - F.log("bad" + p)) * UNIT).cast("long")
    return found.where("more").select("gram", (score("_p") - score("_state")).alias("more"))


def automaton(cells: list, order: int) -> Automaton:
    """Both models by interpolation with the next shorter context, each weighted by its number of different followers (Witten and Bell)."""
    counts: dict[str, dict[int, tuple[int, int]]] = defaultdict(dict)
    for context, last, good, bad in cells:
        counts[context][symbol(last)] = (good, bad)
    names = sorted(counts, key=lambda c: (len(c), c))
    number = {c: i for i, c in enumerate(names)}
    uniform = [1.0 / SYMBOLS] * SYMBOLS
    chances: list[tuple[list[float], list[float]]] = []
    score, follow = [], []
    for context in names:
        shorter = chances[number[context[1:]]] if context else (uniform, uniform)
        both = []
        for side in (0, 1):
            seen = {s: n[side] for s, n in counts[context].items() if n[side]}
            kinds = len(seen)
            below = 1.0 / (sum(seen.values()) + kinds) if kinds else 0.0
            both.append([(seen.get(s, 0) + kinds * p) * below if kinds else p for s, p in enumerate(shorter[side])])
        chances.append((both[0], both[1]))
        score += [round(UNIT * (math.log(g) - math.log(b))) for g, b in zip(*both)]
        for s in range(SYMBOLS):
            ahead = (context + chr(s + 31))[-order:] if order and s != END else ""
            while ahead not in number:
                ahead = ahead[1:]
            follow.append(number[ahead])
    start = PAD * order
    while start not in number:
        start = start[1:]
    return Automaton(number[start], score, follow)


def constants(values: list[int], kind: str) -> Column:
    """One literal array: Catalyst folds the constant, so a cell is read by its place."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def difference(text: Column, model: Automaton) -> Column:
    """Log-likelihood of the text among accepted URLs less that among rejected ones, in 1 / UNIT."""
    score, follow = constants(model.score, "long"), constants(model.follow, "int")
    first = F.struct(F.lit(model.start).alias("state"), F.lit(0).cast("long").alias("total"))

    def step(at: Column, c: Column) -> Column:
        cell = at["state"] * SYMBOLS + F.ascii(c) - 31
        return F.struct(F.get(follow, cell).alias("state"), (at["total"] + F.get(score, cell)).alias("total"))

    end = lambda at: at["total"] + F.get(score, at["state"] * SYMBOLS + END)
    return F.aggregate(characters(text), first, step, end)


def calibration(bins: list[tuple[bool, int, int]]) -> tuple[float, float]:
    """Slope and intercept of a logistic fit to (label, bin, count); (1, 0) unless both labels are there.

    Labels count as slightly uncertain (Platt), so the fit ends even when the classes lie apart.
    """
    n = [sum(c for label, _, c in bins if label is side) for side in (False, True)]
    if not all(n):
        return 1.0, 0.0
    target = {True: (n[1] + 1) / (n[1] + 2), False: 1 / (n[0] + 2)}
    slope, shift = 1.0, 0.0

    def loss(a: float, b: float) -> float:
        return math.fsum(c * (max(z, 0) - target[y] * z + math.log1p(math.exp(-abs(z)))) for y, x, c in bins if (z := a * x / BINS + b) is not None)

    for _ in range(100):
        grad, curve = [0.0, 0.0], [1e-9, 0.0, 1e-9]
        for label, x, count in bins:
            x = x / BINS
            z = slope * x + shift
            p = 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))
            grad = [grad[0] + count * (p - target[label]) * x, grad[1] + count * (p - target[label])]
            w = count * p * (1 - p)
            curve = [curve[0] + w * x * x, curve[1] + w * x, curve[2] + w]
        size = curve[0] * curve[2] - curve[1] * curve[1]
        if size <= 0:
            break
        move = (curve[2] * grad[0] - curve[1] * grad[1]) / size, (curve[0] * grad[1] - curve[1] * grad[0]) / size
        now, scale = loss(slope, shift), 1.0
        while scale > 1e-6 and loss(slope - scale * move[0], shift - scale * move[1]) > now:
            scale /= 2
        slope, shift = slope - scale * move[0], shift - scale * move[1]
        if max(map(abs, move)) * scale < 1e-10:
            break
    return (slope, shift) if slope > 0 else (1.0, 0.0)


def judged(pages: DataFrame, rules: Sequence[Rule] = RULES, order: int = 4, contexts: int | None = None, least: int = 8) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of each row of ``pages``.

    The longest rule (host and path as one text; of two as long, the earlier) that
    fits a URL decides: its host is the rule's or below it, and its path begins with
    the rule's. URLs that rules judge are the examples, all of them, each row counted;
    the model keeps all contexts of ``least`` occurrences, or the ``contexts`` most
    frequent of them if that is given.
    Other URLs are allowed if ``score``, the calibrated chance of an accepted one, is
    0.5 or more. Every URL has a score. If no rule accepts any, or none rejects any, or
    all of one side fall to calibration, there is nothing to compare: scores are 0.5.
    A null URL is read as an empty one; both, and URLs without ``://``, have empty host
    and path and fit no rule. Repeated rows and null page_id are judged alike, an empty
    table gives an empty one, and other columns are ignored.
    """
    spark = pages.sparkSession
    phases = Phases(spark, "urls")
    url = pages.select("page_id", F.col("url").cast("string").alias("url"))
    host, path = parts(F.coalesce("url", F.lit("")))
    known = url.select("page_id", host.alias("host"), path.alias("path"), plain(F.col("url")).alias("text"))
    known = computed_once(known, "host")
    known = known.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)).withColumn("row", F.monotonically_increasing_id())
    known = phases.land(known, "parts")
    labelled = known.where("fit is not null").select(F.col("fit.allow").alias("allow"), "text", (F.pmod(F.xxhash64("text", F.lit(29)), F.lit(HELD)) == 0).alias("held"))
    sides = labelled.groupBy("allow").agg(F.count_if(~F.col("held")).alias("n")).collect()
    if sum(r["n"] > 0 for r in sides) < 2:
        scored = known.withColumn("score", F.lit(0.5))
    else:
        grams = phases.land(gram_counts(labelled.where("not held"), order), "grams")
        cells, kept = retained(grams, order, contexts, least, phases)
        states = phases.land(most_frequent(kept, STATES).select("context"), "states")
        made = automaton([tuple(r) for r in cells.join(F.broadcast(states), "context").collect()], order)
        gained = difference(F.col("text"), made)
        if kept.count() > STATES:
            # a whole context that is a state has nothing longer
            whole = states.where(F.length("context") == order)
            places = grams_in(known, order, "row").withColumn("context", F.substring("gram", 1, order))
            places = places.join(F.broadcast(whole), "context", "left_anti").select("row", "gram")
            more = phases.land(beyond(places.select("gram").distinct(), cells, kept, states, order), "beyond")
            sums = places.join(more, "gram").groupBy("row").agg(F.sum("more").alias("more"))
            known, gained = known.join(sums, "row", "left"), gained + F.coalesce("more", F.lit(0))
        compared = phases.land(known.withColumn("gain", gained / (UNIT * (F.length("text") + 1))), "gains")
        chosen = compared.where("fit is not null").select(F.col("fit.allow").alias("allow"), F.pmod(F.xxhash64("text", F.lit(29)), F.lit(HELD)).alias("fold"), "gain")
        clipped = F.greatest(F.least(F.col("gain"), F.lit(float(WIDEST))), F.lit(-float(WIDEST)))
        bins = chosen.where("fold = 0").groupBy("allow", F.round(clipped * BINS).cast("int").alias("bin")).count()
        slope, shift = calibration(sorted((r["allow"], r["bin"], r["count"]) for r in bins.collect()))
        scored = compared.withColumn("score", F.lit(1.0) / (F.exp(-(F.col("gain") * slope + shift)) + 1))
    allow = F.coalesce(F.col("fit.allow"), F.col("score") >= 0.5)
    return scored.select("page_id", "host", "path", F.col("fit.text").alias("rule"), F.when(allow, "allow").otherwise("block").alias("verdict"), "score")
