"""ROC and precision-recall curves and the areas under them.

Points come from the distinct scores in descending order with running counts
of positives and negatives. No global sort and no single-task window runs over
the scores: they are cut into score ranges, each range starts from the totals
of the ranges above it, and only the running counts within a range need an
order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import nan_to_null
from ..session import landed


def score_counts(df: DataFrame, score: str | Column, label: str | Column = "label", by: Sequence[str] = ()) -> DataFrame:
    """(score, p, n): positives and negatives of each distinct score, apart for
    the values of ``by`` (several models, say), which come first. Rows without
    a score or a label do not count."""
    score, label = (F.col(c) if isinstance(c, str) else c for c in (score, label))
    pairs = df.select(*by, nan_to_null(score).alias("score"), label.cast("double").alias("label"))
    return (
        pairs.filter(F.col("score").isNotNull() & F.col("label").isNotNull())
        .groupBy(*by, "score")
        .agg(F.count_if(F.col("label") > 0.5).alias("p"), F.count_if(F.col("label") <= 0.5).alias("n"))
    )


def running_counts(
    df: DataFrame, score: str | Column, label: str | Column = "label", rows_per_range: int = 250_000, by: Sequence[str] = ()
) -> DataFrame:
    """(score, p, n, rn, tp, fp, scores, positives, negatives) per distinct
    score: its place from the top, the running counts down to it, and the
    totals of the table; with ``by``, all of them within its values.

    The distinct scores are written once, cut into ranges of about
    ``rows_per_range``; where the cuts lie affects the balance alone.
    """
    by = list(by)
    counts = landed(score_counts(df, score, label, by), "scores")
    ranges = counts.count() // rows_per_range + 2
    # The range number must not change between the two uses, so it is written.
    counts = landed(
        counts.repartitionByRange(ranges, *by, F.desc("score")).withColumn("range", F.spark_partition_id()), "ranges"
    )

    # One row per range, and per group in it.
    above = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*by)
    totals = counts.groupBy(*by, "range").agg(
        F.count("*").alias("k"), F.sum("p").alias("p"), F.sum("n").alias("n")
    )
    starts = totals.select(
        *by,
        "range",
        *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("k", "p", "n")],
        F.sum("k").over(everything).alias("scores"),
        F.sum("p").over(everything).alias("positives"),
        F.sum("n").over(everything).alias("negatives"),
    )
    down = Window.partitionBy(*by, "range").orderBy(F.desc("score"))
    so_far = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        counts.withColumns(
            {
                "rn": F.row_number().over(down),
                "tp": F.sum("p").over(so_far),
                "fp": F.sum("n").over(so_far),
            }
        )
        .join(starts, [*by, "range"])
        .select(
            *by,
            "score",
            "p",
            "n",
            (F.col("k_above") + F.col("rn")).alias("rn"),
            (F.col("p_above") + F.col("tp")).alias("tp"),
            (F.col("n_above") + F.col("fp")).alias("fp"),
            "scores",
            "positives",
            "negatives",
        )
    )


def curve(
    df: DataFrame,
    score: str | Column,
    label: str | Column = "label",
    num_bins: int = 0,
    rows_per_range: int = 250_000,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per point: (bin, score, p, n, tp, fp, fpr, tpr, precision,
    recall, positives, negatives), ``bin`` counting from the highest score.
    With ``by`` there is one curve for each of its values.

    With ``num_bins`` every run of ``scores // num_bins`` neighbouring scores
    becomes one point, if that is at least two scores; the remainder gives one
    extra point. 0 keeps every score.
    """
    points = running_counts(df, score, label, rows_per_range, by)
    if num_bins:
        width = F.greatest(F.floor(F.col("scores") / num_bins), F.lit(1)).cast("long")
        points = (
            points.withColumn("bin", F.floor((F.col("rn") - 1) / width).cast("long"))
            .groupBy(*by, "bin")
            .agg(
                F.min("score").alias("score"),
                F.sum("p").alias("p"),
                F.sum("n").alias("n"),
                F.max("tp").alias("tp"),
                F.max("fp").alias("fp"),
                F.max("positives").alias("positives"),
                F.max("negatives").alias("negatives"),
            )
        )
    else:
        points = points.withColumn("bin", (F.col("rn") - 1).cast("long"))
    tp, fp, positives, negatives = (F.col(c).cast("double") for c in ("tp", "fp", "positives", "negatives"))
    return points.select(
        *by,
        "bin",
        "score",
        "p",
        "n",
        "tp",
        "fp",
        F.try_divide(fp, negatives).alias("fpr"),
        F.try_divide(tp, positives).alias("tpr"),
        (tp / (tp + fp)).alias("precision"),
        F.try_divide(tp, positives).alias("recall"),
        "positives",
        "negatives",
    )


def _point(position: Column, x: Column, y: Column) -> Column:
    return F.struct(position.cast("long").alias("position"), x.alias("x"), y.alias("y"))


def roc_curve(points: DataFrame) -> DataFrame:
    """(position, x, y) of the ROC curve from ``curve`` points, with its two
    end points."""
    place = F.col("bin") + 1
    is_last = (F.col("tp") == F.col("positives")) & (F.col("fp") == F.col("negatives"))
    steps = F.array(
        F.when(F.col("bin") == 0, _point(F.lit(0), F.lit(0.0), F.lit(0.0))),
        _point(place, F.col("fpr"), F.col("tpr")),
        F.when(is_last, _point(place + 1, F.lit(1.0), F.lit(1.0))),
    )
    return points.select(F.inline(F.array_compact(steps)))


def pr_curve(points: DataFrame) -> DataFrame:
    """(position, x, y) of the precision-recall curve; it starts at recall 0
    with the precision of the first point."""
    steps = F.array(
        F.when(F.col("bin") == 0, _point(F.lit(0), F.lit(0.0), F.col("precision"))),
        _point(F.col("bin") + 1, F.col("recall"), F.col("precision")),
    )
    return points.select(F.inline(F.array_compact(steps)))


def areas(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Trapezoid areas (auc_roc, auc_pr) under ``curve`` points, one row for each value of ``by``.

    The point before each one is known from its own counts (tp - p, fp - n),
    so this is a plain aggregate without an order.
    """
    p, n, tp, fp = (F.col(c).cast("double") for c in ("p", "n", "tp", "fp"))
    before_tp, before_fp = tp - p, fp - n
    precision = tp / (tp + fp)
    before = F.when(before_tp + before_fp > 0, before_tp / (before_tp + before_fp)).otherwise(precision)
    positives, negatives = F.max("positives").cast("double"), F.max("negatives").cast("double")
    return points.groupBy(*by).agg(
        F.try_divide(F.sum(n * (tp + before_tp)) / 2, positives * negatives).alias("auc_roc"),
        F.try_divide(F.sum(p * (precision + before)) / 2, positives).alias("auc_pr"),
    )


def threshold_cells(running: DataFrame, thresholds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(threshold, tp, fp, tn, fn) if every score above the threshold is called
    positive, for all thresholds and values of ``by`` in one pass over
    ``running_counts``: no model is fitted or applied for a threshold."""
    reached = [F.max(F.when(F.col("score") > t, F.struct("tp", "fp"))) for t in thresholds]
    totals = [F.max(c).alias(c) for c in ("positives", "negatives")]
    # both counts grow down the scores, so the greatest pair is the last one
    wide = running.groupBy(*by).agg(*totals, *[r.alias(f"r{i}") for i, r in enumerate(reached)])
    cells = [F.struct(F.lit(float(t)).alias("threshold"), F.col(f"r{i}").alias("r")) for i, t in enumerate(thresholds)]
    long = wide.select(*by, "positives", "negatives", F.inline(F.array(*cells)))
    tp, fp = (F.coalesce(F.col(f"r.{c}"), F.lit(0)) for c in ("tp", "fp"))
    return long.where("positives is not null").select(
        *by, "threshold", tp.alias("tp"), fp.alias("fp"), (F.col("negatives") - fp).alias("tn"), (F.col("positives") - tp).alias("fn")
    )
