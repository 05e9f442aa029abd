"""Train/test splits."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import key_fraction


def split_random(df: DataFrame, weights: Sequence[float], seed: int = 0) -> list[DataFrame]:
    """Spark's random split. The sides depend on how the input is partitioned,
    so they differ between clusters; prefer ``split_by_key``."""
    return df.randomSplit(list(weights), seed)


def side_of(keys: Sequence[str], weights: Sequence[float], seed: int = 0, level: int = 0) -> Column:
    """Number of the side a row belongs to, from its key alone."""
    total = float(sum(weights))
    place = key_fraction(keys, seed, f"level {level}" if level else "")
    return sum(
        ((place >= F.lit(limit / total)).cast("int") for limit in list(accumulate(weights))[:-1]),
        F.lit(0),
    )


def split_by_key(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float] = (0.7, 0.3), seed: int = 0, level: int = 0
) -> list[DataFrame]:
    """A split that is the same on every cluster: rows with equal keys share a
    side, every row has exactly one. No sort, no shuffle. A split of one side
    of another split takes a ``level`` of its own; with the same level and seed
    the rows of a side would all fall on one side again."""
    side = side_of(keys, weights, seed, level)
    return [df.filter(side == i) for i in range(len(weights))]


def with_fold(df: DataFrame, keys: Sequence[str], folds: int, seed: int = 0, name: str = "fold") -> DataFrame:
    """Add the repeatable fold number cross-validation reads; it is independent of the sides of a split."""
    return df.withColumn(name, F.floor(key_fraction(keys, seed, "fold") * folds).cast("int"))
