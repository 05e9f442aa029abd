"""Column statistics: frequencies, modes, exact quartiles, fences."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import NOT_A_MODE, nan_to_null

QUARTILES = (0.25, 0.5, 0.75)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n), most frequent first; ties in value order."""
    return (
        df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")
    )


def top_k(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in a stated order."""
    return df.orderBy(*order_by).limit(k)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def sample_stddev(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.stddev(column).alias("stddev"))


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for several columns in one pass; values as text.

    Each task counts its own values first, so a value that fills a third of
    the table is one row per task in the shuffle.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = texts.unpivot([], list(columns), "column", "value")
    return long.groupBy("column", "value").agg(F.count("*").alias("n"))


def modes(df: DataFrame, columns: Sequence[str], exclude: Sequence[str] = NOT_A_MODE) -> DataFrame:
    """(column, mode, n): the most frequent value of each column, one pass for
    all. NULL and the ``exclude`` texts do not count; the smaller text wins a
    tie. A column without any value has no row."""
    counts = value_frequencies(df, columns).filter(F.col("value").isNotNull())
    if exclude:
        counts = counts.filter(~F.col("value").isin(*exclude))
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"), F.max("n").alias("n")
    )


def sketch_quantiles(
    df: DataFrame, wanted: dict[str, tuple[Column, Sequence[float]]], k: int = 4096, fan_in: int = 256
) -> dict[str, tuple[int, list[float]]]:
    """Approximate quantiles ``{name: (count, values)}`` of several columns in
    one pass. Every returned value occurs in the column.

    The sketches of the tasks merge in two levels, so that no task ever reads
    one sketch per input partition. The rank error is about 0.13 % of the rows
    at ``k`` = 4096. A column without values gives ``(0, [])``.
    """
    names = list(wanted)
    level = df.select(*[wanted[c][0].alias(c) for c in names])
    level = level.groupBy((F.spark_partition_id() % fan_in).alias("_group")).agg(
        *[F.kll_sketch_agg_double(c, k).alias(c) for c in names]
    )
    level = level.agg(*[F.kll_merge_agg_double(c, k).alias(c) for c in names])
    row = level.select(
        *[F.kll_sketch_get_n_double(c).alias(f"n{i}") for i, c in enumerate(names)],
        *[
            F.when(
                F.kll_sketch_get_n_double(c) > 0,
                F.kll_sketch_get_quantile_double(c, F.array(*[F.lit(float(f)) for f in wanted[c][1]])),
            ).alias(f"q{i}")
            for i, c in enumerate(names)
        ],
    ).first()
    return {c: (row[f"n{i}"] or 0, list(row[f"q{i}"] or [])) for i, c in enumerate(names)}


@dataclass
class _Target:
    """One wanted quantile and the open interval its value must lie in."""

    column: str
    prob: float
    value: Column
    rank: int = 0  # 1-based rank of the wanted value
    low: float | None = None
    high: float | None = None
    below: int = 0  # values <= low
    upto: int = 0  # values < high
    bounds: tuple[float, float] = (0.0, 0.0)
    answer: float | None = None

    @property
    def inside(self) -> int:
        return self.upto - self.below

    def interior(self) -> Column:
        limits = [] if self.low is None else [self.value > self.low]
        limits += [] if self.high is None else [self.value < self.high]
        return F.when(reduce(and_, limits, self.value.isNotNull()), self.value)

    def narrow(self, first: Sequence[int], second: Sequence[int]) -> None:
        """Settle, or shrink the interval, from the (less, less-or-equal)
        counts of the two bounds."""
        for bound, (less, upto) in zip(self.bounds, (first, second)):
            if less < self.rank <= upto:
                self.answer = bound
                return
            if self.rank <= less:
                self.high, self.upto = bound, less
                return
            self.low, self.below = bound, upto


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(id, value): one row per column and value, ``id`` being its place."""
    pairs = [x for i, c in enumerate(columns) for x in (F.lit(i), F.col(c))]
    return df.select(F.stack(F.lit(len(columns)), *pairs).alias("id", "value")).filter("value is not null")


def _of_column(values: Sequence[float | None]) -> Column:
    """The constant that belongs to the column of a ``_long`` row."""
    return F.get(F.array(*[F.lit(v).cast("double") for v in values]), F.col("id"))


def _count_bounds(df: DataFrame, columns: list[str], slots: list[list[_Target | None]]) -> None:
    """Narrow every target by the number of values below and up to its bounds."""
    value = F.col("value")
    tests = []
    for slot in slots:
        for side in (0, 1):
            bound = _of_column([t.bounds[side] if t else None for t in slot])
            tests += [F.count_if(value < bound), F.count_if(value <= bound)]
    counted = _long(df, columns).groupBy("id").agg(F.array(*tests).alias("counts"))
    for row in counted.collect():
        for j, slot in enumerate(slots):
            if target := slot[row["id"]]:
                a, b, c, d = row["counts"][4 * j : 4 * j + 4]
                target.narrow((a, b), (c, d))


def _pick_inside(df: DataFrame, columns: list[str], slots: list[list[_Target | None]]) -> None:
    """Settle every target from the sorted values inside its interval."""
    value, nothing = F.col("value"), (math.inf, -math.inf)
    inside = []
    for slot in slots:
        low, high = zip(*[(t.low, t.high) if t else nothing for t in slot])
        above, below = value > _of_column(low), value < _of_column(high)
        inside.append(F.coalesce(above, F.lit(True)) & F.coalesce(below, F.lit(True)))
    found = _long(df, columns).filter(reduce(or_, inside))
    places = F.array_compact(F.array(*[F.when(test, F.lit(j)) for j, test in enumerate(inside)]))
    place = F.get(
        F.array(*[F.lit(t.rank - t.below - 1 if t else None).cast("int") for slot in slots for t in slot]),
        F.col("slot") * len(columns) + F.col("id"),
    )
    picked = (
        found.select("id", "value", F.explode(places).alias("slot"))
        .groupBy("id", "slot")
        .agg(F.sort_array(F.collect_list("value")).alias("values"))
        .select("id", "slot", F.get("values", place).alias("answer"))
    )
    for row in picked.collect():
        slots[row["slot"]][row["id"]].answer = row["answer"]


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float] = QUARTILES,
    k: int = 4096,
    finish_rows: int = 50_000,
) -> dict[str, list[float | None]]:
    """Exact element-valued quantiles, all columns together, without a sort
    and without shuffling values.

    A sketch names two values that should enclose each quantile; a counting
    pass then proves where the wanted rank lies: on a bound (settled) or
    strictly between two values. That interval holds about half a percent of
    its rows, so it shrinks some 200-fold per round until at most
    ``finish_rows`` values are left, from which the rank is read off. The
    counts, not the sketch, decide: the result is exact whatever the sketch
    says. Passes: 2 when the quantiles are frequent values, 3 up to about ten
    million rows, 7 at 10^12.

    NULL and NaN do not count. A column without values yields ``None``s.
    """
    df = df.select(*[nan_to_null(c).alias(c) for c in columns])
    targets = [_Target(c, p, F.col(c)) for c in columns for p in probs]
    # Twice the rank error of the sketch; less if that would hardly narrow.
    margin = min(0.2, 2 * sketch_error(k))

    spread = [_clip(p + d) for p in probs for d in (-margin, margin)]
    sketches = sketch_quantiles(df, {c: (F.col(c), spread) for c in columns}, k)
    for i, t in enumerate(targets):
        n, bounds = sketches[t.column]
        if n:
            j = 2 * (i % len(probs))
            t.rank, t.upto = max(1, math.ceil(t.prob * n)), n
            t.bounds = (bounds[j], bounds[j + 1])
    open_targets = [t for t in targets if t.rank]

    def by_column(wanted: list[_Target]) -> tuple[list[str], list[list[_Target | None]]]:
        names = list(dict.fromkeys(t.column for t in wanted))
        place = {(t.column, t.prob): t for t in wanted}
        return names, [[place.get((c, p)) for c in names] for p in probs]

    while open_targets:
        _count_bounds(df, *by_column(open_targets))
        open_targets = [t for t in open_targets if t.answer is None]
        if all(t.inside <= finish_rows for t in open_targets):
            break
        places = {
            str(i): [_clip((t.rank - t.below) / t.inside + d) for d in (-margin, margin)]
            for i, t in enumerate(open_targets)
        }
        sketches = sketch_quantiles(
            df, {str(i): (t.interior(), places[str(i)]) for i, t in enumerate(open_targets)}, k
        )
        for i, t in enumerate(open_targets):
            t.bounds = tuple(sketches[str(i)][1])

    if open_targets:
        # At most finish_rows values for each target, as counted above.
        _pick_inside(df, *by_column(open_targets))

    found = iter(targets)
    return {c: [next(found).answer for _ in probs] for c in columns}


def quartiles(df: DataFrame, columns: Sequence[str], exact: bool = True, k: int = 4096) -> DataFrame:
    """(column, q1, median, q3), one row per column.

    ``exact=False`` takes them from one sketch pass instead.
    """
    if exact:
        found = exact_quantiles(df, columns, k=k)
    else:
        sketches = sketch_quantiles(df, {c: (nan_to_null(c), QUARTILES) for c in columns}, k)
        found = {c: q or [None] * len(QUARTILES) for c, (_, q) in sketches.items()}
    return df.sparkSession.createDataFrame(
        [(c, *found[c]) for c in columns], "column string, q1 double, median double, q3 double"
    )


def sketch_error(k: int = 4096) -> float:
    """Rank error of a sketch as a share of the rows: the published bound of its kind, at 99 %."""
    return 2.296 / k**0.9021


def rank_certificate(df: DataFrame, found: dict[str, Sequence[float | None]], probs: Sequence[float] = QUARTILES) -> DataFrame:
    """(column, prob, value, n, below, upto, rank_error): how far off each proposed quantile truly is.

    One pass counts, for all columns together, the values below and up to each proposed
    one. The wanted rank is the least that covers ``prob`` of the ``n`` values;
    ``rank_error`` is its distance to the ranks that the value holds, as a share of
    ``n``: 0 certifies the exact quantile, whatever proposed it. A column without
    values, or without a proposal, has NULL.
    """
    columns = list(found)
    values = df.select(*[nan_to_null(c).alias(c) for c in columns])
    tests = []
    for j in range(len(probs)):
        bound = _of_column([found[c][j] for c in columns])
        tests += [F.count_if(F.col("value") < bound), F.count_if(F.col("value") <= bound)]
    counted = _long(values, columns).groupBy("id").agg(F.count("*").alias("n"), F.array(*tests).alias("counts")).collect()
    counted = {r["id"]: r for r in counted}
    rows = []
    for i, c in enumerate(columns):
        n = counted[i]["n"] if i in counted else 0
        for j, p in enumerate(probs):
            value = found[c][j]
            below, upto = counted[i]["counts"][2 * j : 2 * j + 2] if n else (0, 0)
            rank = max(1, math.ceil(p * n))
            off = max(0, below + 1 - rank, rank - upto) / n if n and value is not None else None
            rows.append((c, float(p), value, n, below, upto, off))
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double, n long, below long, upto long, rank_error double")


def certified_quartiles(df: DataFrame, columns: Sequence[str], k: int = 4096) -> DataFrame:
    """Quartiles from one sketch pass with the ``rank_certificate`` of each."""
    sketches = sketch_quantiles(df, {c: (nan_to_null(c), QUARTILES) for c in columns}, k)
    return rank_certificate(df, {c: q or [None] * len(QUARTILES) for c, (_, q) in sketches.items()})


def fences(q1: float, q3: float) -> tuple[float, float]:
    """Outlier limits: one and a half interquartile ranges off the quartiles."""
    reach = 1.5 * (q3 - q1)
    return q1 - reach, q3 + reach


def iqr_bounds(quartile_table: DataFrame) -> DataFrame:
    """Add the outlier fences ``lower`` and ``upper`` to a quartile table."""
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    return quartile_table.select(
        "column", "q1", "median", "q3", (F.col("q1") - reach).alias("lower"), (F.col("q3") + reach).alias("upper")
    )


def _clip(fraction: float) -> float:
    return min(1.0, max(0.0, fraction))
