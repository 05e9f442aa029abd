"""How complete the columns of a table are, and how many values they hold.

A profile is a small table with one row per column whose counts add up and whose
distinct-value sketches merge: profiles of parts (days, files, sides of a split)
make the profile of the whole without reading a row again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from ..functions.columns import MISSING

#: Base-2 logarithm of the registers of a sketch.
REGISTERS = 12


def distinct_error(registers: int = REGISTERS) -> float:
    """Relative standard error of a merged distinct count; three times it is all but certain to hold."""
    return 1.04 / math.sqrt(2**registers)


def _facts(name: str, kind, sentinels: Sequence[str]) -> dict[str, Column]:
    value = F.col(f"`{name}`")
    nan = F.isnan(value) if isinstance(kind, (DoubleType, FloatType)) else F.lit(False)
    sentinel = value.isin(*sentinels) if isinstance(kind, StringType) and sentinels else F.lit(False)
    # a missing value is none of the column's; -0.0 and 0.0 are one value
    plain = value + F.lit(0).cast(kind) if isinstance(kind, (DoubleType, FloatType)) else value
    held = F.when(value.isNotNull() & ~nan & ~sentinel, F.xxhash64(plain))
    return {"nulls": value.isNull(), "nans": F.coalesce(nan, F.lit(False)), "sentinels": F.coalesce(sentinel, F.lit(False)), "sketch": held}


def profile(
    df: DataFrame, columns: Sequence[str] | None = None, sentinels: Sequence[str] = (MISSING,), registers: int = REGISTERS, fan_in: int = 256
) -> DataFrame:
    """(column, kind, rows, nulls, nans, sentinels, sketch) of all columns in one pass.

    NaN counts in floating columns, a sentinel in text columns; the sketch holds the
    values that are none of the three. Each task sends one row, and the sketches merge
    in two levels. An empty table has zero counts.
    """
    types = {f.name: f.dataType for f in df.schema}
    names = list(types) if columns is None else list(columns)
    wide = []
    for i, c in enumerate(names):
        facts = _facts(c, types[c], sentinels)
        wide += [facts[k].cast("int").alias(f"{k}{i}") for k in ("nulls", "nans", "sentinels")] + [facts["sketch"].alias(f"s{i}")]
    level = df.select(F.spark_partition_id().alias("_part"), *wide).groupBy((F.col("_part") % fan_in).alias("_group")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(f"{k}{i}").alias(f"{k}{i}") for i in range(len(names)) for k in ("nulls", "nans", "sentinels")],
        *[F.hll_sketch_agg(f"s{i}", registers).alias(f"s{i}") for i in range(len(names))],
    )
    per_column = [
        F.struct(
            F.lit(c).alias("column"), F.lit(types[c].simpleString()).alias("kind"), F.col("rows"),
            *[F.col(f"{k}{i}").alias(k) for k in ("nulls", "nans", "sentinels")], F.col(f"s{i}").alias("sketch"),
        )
        for i, c in enumerate(names)
    ]
    rows = level.select(F.inline(F.array(*per_column)))
    empty = df.sparkSession.createDataFrame([(c, types[c].simpleString()) for c in names], "column string, kind string")
    none = [F.lit(0).cast("long").alias(c) for c in ("rows", "nulls", "nans", "sentinels")]
    return merged(rows.unionByName(empty.select("column", "kind", *none, F.lit(None).cast("binary").alias("sketch"))))


def merged(*profiles: DataFrame) -> DataFrame:
    """One profile of several. The same column must be of one kind and have sketches of one size."""
    rows = profiles[0]
    for p in profiles[1:]:
        rows = rows.unionByName(p)
    counts = [F.sum(c).alias(c) for c in ("rows", "nulls", "nans", "sentinels")]
    return rows.groupBy("column", "kind").agg(*counts, F.hll_union_agg("sketch", True).alias("sketch"))


def rates(found: DataFrame) -> DataFrame:
    """(column, kind, rows, nulls, nans, sentinels, null_rate, nan_rate, sentinel_rate, missing_rate, distinct_estimate).

    Counts and rates are exact; ``distinct_estimate`` is off by ``distinct_error`` as a
    standard error, and exact for few values. Rates of an empty table are NULL.
    """
    rows = F.col("rows").cast("double")
    missing = F.col("nulls") + F.col("nans") + F.col("sentinels")
    return found.select(
        "column", "kind", "rows", "nulls", "nans", "sentinels",
        *[F.try_divide(F.col(c).cast("double"), rows).alias(n) for c, n in (("nulls", "null_rate"), ("nans", "nan_rate"), ("sentinels", "sentinel_rate"))],
        F.try_divide(missing.cast("double"), rows).alias("missing_rate"),
        F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).cast("long").alias("distinct_estimate"),
    )


def sparse_columns(found: DataFrame, limit: float) -> list[str]:
    """Columns of which ``limit`` or more is missing, by name."""
    return sorted(r["column"] for r in rates(found).where(F.col("missing_rate") >= limit).select("column").collect())
