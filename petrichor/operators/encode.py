"""Categories to numbers: label tables, pipeline stages, chi-square, tokens."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import (
    HashingTF,
    IndexToString,
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import landed
from .stats import value_frequencies

# Suffixes of the encoded columns.
INDEXED = "_num"
HOT = "_hot"


def _label_order(order: str) -> list[Column]:
    value, n = F.col("value"), F.col("n")
    orders = {
        "alphabetDesc": [value.desc()],
        "alphabetAsc": [value.asc()],
        "frequencyDesc": [n.desc(), value.asc()],
        "frequencyAsc": [n.asc(), value.asc()],
    }
    return orders[order]


def label_table(df: DataFrame, columns: Sequence[str], order: str = "alphabetDesc") -> DataFrame:
    """(column, value, n, index): the number of every category, all columns in
    one pass. Numbers are ordered as texts, as the pipeline indexer does.

    The distinct values are range-partitioned and numbered within the ranges,
    however many or few they are.
    """
    labels = value_frequencies(df, columns).filter(F.col("value").isNotNull())
    return landed(number_by_ranges(labels, _label_order(order)), "labels")


def number_by_ranges(labels: DataFrame, by: Sequence[Column]) -> DataFrame:
    """(column, value, n, index) of (column, value, n): numbers from 0 within each column, in the given order.

    Rows are sorted within ranges and numbered in the order of each range's file;
    the driver sees one row per range and column, where the column's part starts.
    """
    # The range number must not change between the two uses, so it is written.
    ranged = labels.repartitionByRange(F.col("column"), *by).sortWithinPartitions("column", *by)
    ranged = landed(ranged.withColumn("_id", F.monotonically_increasing_id()), "ranges")
    part, row = F.shiftright("_id", 33).cast("int"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    parts = ranged.groupBy("column", part.alias("part")).agg(F.min(row).alias("first"), F.count("*").alias("size")).collect()
    starts, before = [], {}
    for r in sorted(parts, key=lambda r: r["part"]):
        starts += [F.lit(f"{r['part']}:{r['column']}"), F.lit(before.get(r["column"], 0) - r["first"]).cast("long")]
        before[r["column"]] = before.get(r["column"], 0) + r["size"]
    offset = F.element_at(F.create_map(*starts), F.concat(part.cast("string"), F.lit(":"), "column")) if starts else F.lit(0)
    return ranged.select("column", "value", "n", (row + offset).cast("double").alias("index"))


def apply_labels(
    df: DataFrame, labels: DataFrame, columns: Sequence[str], invalid: str = "error", suffix: str = INDEXED
) -> DataFrame:
    """Add ``<column>_num`` from a label table, one join per column.

    The label table is a file, so Catalyst knows its size: it is broadcast
    while small, and otherwise joined by shuffle, where adaptive execution
    splits the partitions of frequent values. NULL or unseen categories raise
    (``error``), lose their row (``skip``) or get the next free number
    (``keep``).
    """
    if invalid not in ("error", "skip", "keep"):
        raise ValueError(f"invalid must be error, skip or keep, not {invalid!r}")
    for c in columns:
        target, text = c + suffix, F.col(c).cast("string")
        own = labels.filter(F.col("column") == c).select(F.col("value").alias("_value"), F.col("index").alias(target))
        df = df.join(own, text == F.col("_value"), "inner" if invalid == "skip" else "left").drop("_value")
        if invalid == "error":
            unseen = F.raise_error(F.concat(F.lit(f"unseen or missing category in {c}: "), F.coalesce(text, F.lit("NULL"))))
            df = df.withColumn(target, F.coalesce(F.col(target), unseen.cast("double")))
        elif invalid == "keep":
            spare = labels.filter(F.col("column") == c).count()
            df = df.withColumn(target, F.coalesce(F.col(target), F.lit(float(spare))))
    return df


def string_indexer(
    columns: Sequence[str], order: str = "alphabetDesc", invalid: str = "error", suffix: str = INDEXED
) -> StringIndexer:
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[c + suffix for c in columns],
        stringOrderType=order,
        handleInvalid=invalid,
    )


def label_indexer(label: str, order: str = "alphabetDesc", output: str = "label", invalid: str = "error") -> StringIndexer:
    return StringIndexer(inputCol=label, outputCol=output, stringOrderType=order, handleInvalid=invalid)


def one_hot_encoder(columns: Sequence[str]) -> OneHotEncoder:
    """Indicator vectors of indexed columns; the last category is all zeros."""
    return OneHotEncoder(inputCols=[c + INDEXED for c in columns], outputCols=[c + HOT for c in columns])


def assembler(columns: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output)


def all_but(df: DataFrame, *excluded: str) -> list[str]:
    """Every column of the table except the named ones, in order."""
    return [c for c in df.columns if c not in excluded]


def index_to_string(df: DataFrame, indexer: StringIndexerModel, column: str = "label", output: str = "original") -> DataFrame:
    """Give back the class text behind an index."""
    return IndexToString(inputCol=column, outputCol=output, labels=indexer.labels).transform(df)


def chi_square(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, statistic, degrees_of_freedom) of the independence test of
    each category column against the label, all from one counting pass.

    Rows where the feature or the label is missing do not count. Only the
    cells that occur are stored; an empty one adds its expected count, and
    together those are what the others leave of ``n``.
    """
    texts = df.select(F.col(label).cast("string").alias("_label"), *[F.col(c).cast("string").alias(c) for c in features])
    cells = (
        texts.filter(F.col("_label").isNotNull())
        .unpivot(["_label"], list(features), "feature", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value", "_label")
        .agg(F.count("*").cast("double").alias("o"))
    )
    # Written once: the cells feed two counts, and the class totals, one row
    # per feature and class, are then of a known size for the join.
    cells = landed(cells, "cells")
    of_feature = Window.partitionBy("feature")
    classes = landed(
        cells.groupBy("feature", "_label")
        .agg(F.sum("o").alias("c"))
        .select("feature", "_label", "c", F.sum("c").over(of_feature).alias("n"), F.count("*").over(of_feature).alias("labels")),
        "classes",
    )
    # All cells of one category meet in one task: one row per class.
    by_value = cells.withColumn("r", F.sum("o").over(Window.partitionBy("feature", "value"))).join(
        classes, ["feature", "_label"]
    )
    expected = F.col("r") * F.col("c") / F.col("n")
    per_value = by_value.groupBy("feature", "value").agg(
        F.sum((F.col("o") - expected) * (F.col("o") - expected) / expected).alias("part"),
        F.sum(expected).alias("expected"),
        F.count("*").alias("cells"),
        F.max("n").alias("n"),
        F.max("labels").alias("labels"),
    )
    values, labels = F.count("*"), F.max("labels")
    empty = F.when(F.sum("cells") < values * labels, F.max("n") - F.sum("expected")).otherwise(0.0)
    return per_value.groupBy("feature").agg(
        (F.sum("part") + empty).alias("statistic"),
        ((values - 1) * (labels - 1)).cast("int").alias("degrees_of_freedom"),
    )


def upper_tail(statistic: float, degrees_of_freedom: int) -> float:
    """Probability that a chi-square variable exceeds the statistic.

    The regularised upper incomplete gamma function: its series below the mean,
    its continued fraction above.
    """
    a, x = degrees_of_freedom / 2, statistic / 2
    if degrees_of_freedom <= 0 or x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        i = 0
        while term > total * 1e-17:
            i += 1
            term *= x / (a + i)
            total += term
        return max(0.0, 1 - scale * total)
    b = x + 1 - a
    c, d = 1e300, 1 / b
    value = d
    for i in range(1, 100_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b)
        c = b + step / c
        value *= c * d
        if abs(c * d - 1) < 1e-16:
            break
    return scale * value


def chi_square_p_values(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``chi_square`` with ``p_value``, for any number of categories. One row
    per feature reaches the driver."""
    found = landed(chi_square(df, features, label), "chi-square")
    tails = [v for r in found.collect() for v in (F.lit(r.feature), F.lit(upper_tail(r.statistic, r.degrees_of_freedom)))]
    p_value = F.try_element_at(F.create_map(*tails), F.col("feature")) if tails else F.lit(None).cast("double")
    return found.withColumn("p_value", p_value)


def chi_square_test(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """The same test on an assembled vector, with p-values:
    (featureIndex, pValue, degreesOfFreedom, statistic)."""
    return ChiSquareTest.test(df, features, label, flatten=True)


def token_counts(df: DataFrame, text: str, words: str = "words") -> DataFrame:
    """Add the lower-cased, blank-separated words and their number."""
    tokens = Tokenizer(inputCol=text, outputCol=words).transform(df)
    return tokens.withColumn("n_words", F.size(words))


def term_frequencies(df: DataFrame, text: str, buckets: int = 2**18, output: str = "features") -> DataFrame:
    """Hash the words of a text into a sparse count vector."""
    tokens = Tokenizer(inputCol=text, outputCol="_words").transform(df)
    return HashingTF(inputCol="_words", outputCol=output, numFeatures=buckets).transform(tokens).drop("_words")
