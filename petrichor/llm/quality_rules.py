"""Quality rules as a short-circuit cascade, in built-in functions only.

Every rule is a predicate that is true when a text fails it. Their verdict
doesn't depend on their order, only the work does: each rule's cost and share
of rejections are measured on a bounded sample, and the rules run as one CASE
chain by rejections per cost, so a text that an early rule rejects never pays
for the later ones.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .phases import Phases, computed_once

SEPARATORS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÊÀÇÑÓÍÁÚ"


@dataclass(frozen=True)
class Limits:
    """Base: fewest words, most percent of words in repeated windows. The rest: most per word, line or character."""

    min_words: int = 10
    repeat_percent: int = 20
    symbols_per_word: float = 0.3
    bangs_per_word: float = 0.5
    upper_share: float = 0.5
    dup_line_share: float = 0.5
    word_chars: tuple[float, float] = field(default=(1.5, 25.0))


def _chars(text: Column, drop: str) -> Column:
    """How many characters of ``drop`` the text has."""
    return F.length(text) - F.length(F.translate(text, drop, ""))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base measures as columns ``__q_*`` (a null text has no words)."""
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("__q_body", body)
    trimmed = F.trim(F.col("__q_body"), F.lit(SEPARATORS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    out = out.withColumn("__q_codes", F.transform(words, lambda w: F.xxhash64(w)))
    out = out.withColumn("__q_n", F.size("__q_codes").cast("long"))
    codes = F.col("__q_codes")
    windows = F.transform(
        F.when(F.col("__q_n") >= 5, F.slice(codes, F.lit(1), F.size(codes) - 4)).otherwise(F.array().cast("array<long>")),
        lambda c, i: F.xxhash64(c, *(F.get(codes, i + k) for k in range(1, 5))),
    )
    out = out.withColumn("__q_windows", windows).drop("__q_codes")
    repeats = F.size(F.array_distinct("__q_windows")) < F.size("__q_windows")
    placed = F.sort_array(F.transform("__q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("__q_sorted", F.when(repeats, placed)).drop("__q_windows")
    ordered = F.col("__q_sorted")
    again = F.filter(
        ordered,
        lambda x, i: F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)),
    )
    places = F.sort_array(F.transform(again, lambda x: x["i"]))
    total = F.aggregate(
        places,
        F.struct(F.lit(-9).alias("last"), F.lit(0).alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(5), i - s["last"])).alias("n")),
        lambda s: s["n"],
    )
    lines = F.filter(F.split("__q_body", "\n", -1), lambda x: F.trim(x, F.lit(SEPARATORS)) != "")
    out = out.withColumn("__q_repeat", F.coalesce(F.when(ordered.isNotNull(), total), F.lit(0)).cast("long")).drop("__q_sorted")
    out = out.withColumn("__q_lines", lines)
    squeezed = F.translate("__q_body", SEPARATORS, "")
    return computed_once(
        out.withColumn("__q_n_lines", F.size("__q_lines").cast("long"))
        .withColumn("__q_dup_lines", (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long"))
        .withColumn("__q_chars", F.length(squeezed).cast("long"))
        .withColumn("__q_symbols", _chars(F.col("__q_body"), SYMBOLS).cast("long"))
        .drop("__q_lines"),
        "__q_n",
    )


def base_failed(limits: Limits) -> Column:
    return (F.col("__q_n") < limits.min_words) | (100 * F.col("__q_repeat") > limits.repeat_percent * F.col("__q_n"))


def rules(limits: Limits) -> dict[str, Column]:
    """Predicates over the measures and the text; true means rejected. All are false or true, never null."""
    n, body = F.col("__q_n"), F.col("__q_body")
    low, high = limits.word_chars
    return {
        "symbols": F.col("__q_symbols") > limits.symbols_per_word * n,
        "bangs": _chars(body, "!") > limits.bangs_per_word * n,
        "upper_case": _chars(body, _UPPER) > limits.upper_share * F.col("__q_chars"),
        "repeated_lines": F.col("__q_dup_lines") > limits.dup_line_share * F.col("__q_n_lines"),
        "word_length": (F.col("__q_chars") < low * n) | (F.col("__q_chars") > high * n),
    }


def cascade_order(sample: DataFrame, checks: dict[str, Column]) -> list[str]:
    """Rule names by rejected rows per second on the measured ``sample``; ties by name.

    Each rule is timed alone over the sample, less the time of a pass that
    applies no rule. An empty sample gives the rules by name.
    """

    def passed(check: Column) -> tuple[float, int]:
        began = time.perf_counter()
        hits = sample.agg(F.count_if(check)).first()[0]
        return time.perf_counter() - began, hits

    passed(F.lit(False))  # the first pass also compiles and caches
    empty, _ = passed(F.lit(False))
    gain = {}
    for name in sorted(checks):
        seconds, hits = passed(checks[name])
        gain[name] = hits / max(seconds - empty, 1e-3)
    return sorted(gain, key=lambda name: (-gain[name], name))


def judged(docs: DataFrame, limits: Limits = Limits(), sample_rows: int = 1000, text: str = "text") -> DataFrame:
    """``docs`` with ``__q_*`` measures, ``__q_base_failed``, ``__q_rule`` and ``__q_kept``.

    ``__q_rule`` names the first rule of the cascade that rejected the row (null
    if none did or the base failed); ``__q_kept`` is true if the base and all
    rules passed. Null and empty texts have no words and fail the base. Every
    row is judged alone, so repeated rows and ids get equal verdicts, an empty
    table gives an empty one, and columns of any other name pass through.
    ``sample_rows`` bounds the rows that only the order of the rules is learned
    from; no verdict depends on them.
    """
    checks = rules(limits)
    spark, sample = docs.sparkSession, docs.select(text)
    # collecting a limit reads as few partitions as hold that many rows; a limit inside a plan would read from each
    rows = [r[0] for r in sample.limit(sample_rows).collect()]
    # as an Arrow table, since rows would start Python workers, which stay beside the later stages
    sample = spark.createDataFrame(pa.table([pa.array(rows, pa.string())], [text]), sample.schema)
    sample = Phases(spark, "quality").land(measured(sample, text), "sample")
    order = cascade_order(sample, checks)
    out = measured(docs, text).withColumn("__q_base_failed", base_failed(limits))
    chain = F.when(F.col("__q_base_failed"), F.lit(None).cast("string"))
    for name in order:
        chain = chain.when(checks[name], F.lit(name))
    out = out.withColumn("__q_rule", chain)
    return out.withColumn("__q_kept", ~F.col("__q_base_failed") & F.col("__q_rule").isNull())


def kept_documents(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    return judged(docs, limits).where("__q_kept").select(*[F.col(f"`{c}`") for c in docs.columns])
