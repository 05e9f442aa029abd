"""Column expressions shared by the operators. All are built-in functions, so
they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F

# The text that marks a missing value in the source files, and
# the texts that never count as a most frequent value.
MISSING = "NA"
NOT_A_MODE = ("null", "NA")


def month_of(date: str | Column) -> Column:
    """Month number of a ``yyyy-mm-dd`` string; NULL when it cannot be read."""
    return F.get(F.split(_col(date), "-"), F.lit(1)).try_cast("int")


def sentinel_to_null(value: str | Column, sentinels: Sequence[str] = (MISSING,)) -> Column:
    value = _col(value)
    return F.when(~value.isin(*sentinels), value)


def nan_to_null(value: str | Column) -> Column:
    value = _col(value).cast("double")
    return F.when(~F.isnan(value), value)


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def all_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns])


def cap_and_fill(value: str | Column, lower: float, median: float, upper: float) -> Column:
    """Pull values outside the fences onto them and fill the missing ones.

    NaN counts as missing; without that it would compare above every fence.
    """
    value = nan_to_null(value)
    return (
        F.when(value.isNull(), F.lit(median))
        .otherwise(F.least(F.greatest(value, F.lit(lower)), F.lit(upper)))
    )


def fill_with_mode(value: str | Column, mode: Column, sentinels: Sequence[str] = (MISSING,)) -> Column:
    return F.coalesce(sentinel_to_null(value, sentinels), mode)


def fill_outside_domain(value: str | Column, mode: Column, lowest: int, highest: int) -> Column:
    value = _col(value)
    return F.when(value.between(lowest, highest), value).otherwise(mode)


def key_fraction(keys: Sequence[str], seed: int = 0, purpose: str = "") -> Column:
    """A number in [0, 1) that depends on the key values, the seed and the purpose alone.

    It does not change with partitioning, row order or cluster size. A NULL
    key part counts as an empty text. Numbers for different purposes are
    independent, so the folds of one side of a split are as large as any.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(f"{purpose}|{seed}" if purpose else str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def class_probability(probability: str | Column = "probability", index: int = 1) -> Column:
    """One element of a probability (or feature) vector as a double."""
    return F.get(vector_to_array(_col(probability)), F.lit(index))


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
