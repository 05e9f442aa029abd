"""Classification metrics. The predictions are counted into (label,
prediction) cells once; everything else is arithmetic on those few rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def cells(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n): at most classes squared rows."""
    return predictions.groupBy(
        F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
    ).agg(F.count("*").alias("n"))


def accuracy_error(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return predictions.agg(F.avg(hit).alias("accuracy")).withColumn("error", 1 - F.col("accuracy"))


def error_rate(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Wrong rows, all rows and their ratio."""
    wrong = F.col(label).cast("double") != F.col(prediction).cast("double")
    return predictions.agg(F.count_if(wrong).alias("errors"), F.count("*").alias("n")).withColumn(
        "error_rate", F.try_divide(F.col("errors").cast("double"), F.col("n").cast("double"))
    )


def class_metrics(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: support, predicted, tp, precision, true- and false-positive
    rate, f1. A rate without a base is NULL."""
    sides = cells(predictions, label, prediction).select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
                F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
            )
        ).alias("side"),
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
    )
    # Every cell appears on both sides, so a hit is counted twice.
    per_class = sides.groupBy("side.class").agg(
        F.sum("side.support").alias("support"),
        F.sum("side.predicted").alias("predicted"),
        (F.sum("hits") / 2).cast("long").alias("tp"),
    )
    total = F.sum("support").over(Window.partitionBy())  # one row per class
    tp, support, predicted = (F.col(c).cast("double") for c in ("tp", "support", "predicted"))
    return per_class.withColumn("total", total).select(
        F.col("class").alias("label"),
        "support",
        "predicted",
        "tp",
        F.try_divide(tp, predicted).alias("precision"),
        F.try_divide(tp, support).alias("true_positive_rate"),
        F.try_divide(predicted - tp, F.col("total") - support).alias("false_positive_rate"),
        F.try_divide(2 * tp, support + predicted).alias("f1"),
    )


def weighted_metrics(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Class metrics averaged by class support, as one row."""
    weight = F.col("support").cast("double")

    def mean(column: str):
        return F.try_divide(F.sum(weight * F.coalesce(F.col(column), F.lit(0.0))), F.sum(weight))

    return class_metrics(predictions, label, prediction).agg(
        mean("precision").alias("weighted_precision"),
        mean("true_positive_rate").alias("weighted_true_positive_rate"),
        mean("false_positive_rate").alias("weighted_false_positive_rate"),
        mean("f1").alias("weighted_f1"),
    )


def confusion_matrix(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction", positive: float = 1.0
) -> DataFrame:
    """tp, fp, tn, fn in one pass."""
    said, true = F.col(prediction).cast("double") == positive, F.col(label).cast("double") == positive
    return predictions.agg(
        F.count_if(said & true).alias("tp"),
        F.count_if(said & ~true).alias("fp"),
        F.count_if(~said & ~true).alias("tn"),
        F.count_if(~said & true).alias("fn"),
    )


def confusion_rates(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction", positive: float = 1.0
) -> DataFrame:
    """Confusion counts with accuracy, recall, false-positive rate, precision."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    return confusion_matrix(predictions, label, prediction, positive).select(
        "tp",
        "fp",
        "tn",
        "fn",
        F.try_divide(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(fp, fp + tn).alias("false_positive_rate"),
        F.try_divide(tp, tp + fp).alias("precision"),
    )


def error_confidence(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Error rate with two intervals.

    ``ci95_*`` is the 95 % normal interval. ``ci_ref_*`` divides the variance
    by 1.96 and ignores the number of rows; it is kept for comparison with
    results that were published that way.
    """
    err = F.col("error_rate")
    spread = err * (1 - err)
    return error_rate(predictions, label, prediction).select(
        "n",
        "error_rate",
        (err - F.sqrt(spread / 1.96)).alias("ci_ref_low"),
        (err + F.sqrt(spread / 1.96)).alias("ci_ref_high"),
        (err - 1.96 * F.sqrt(spread / F.col("n"))).alias("ci95_low"),
        (err + 1.96 * F.sqrt(spread / F.col("n"))).alias("ci95_high"),
    )
