"""Where models and curves are kept."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def save_model(model: PipelineModel, path: str) -> None:
    """Store the whole pipeline: imputation values, category codes, learner."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_curve(points: DataFrame, path: str, binned: bool = False) -> None:
    """Write (position, x, y) points as text, range-partitioned into ordered files.

    With ``binned`` the points are few, about one per bin, and become one
    ordered file instead.
    """
    ordered = points.coalesce(1).sortWithinPartitions("position") if binned else points.orderBy("position")
    ordered.write.mode("overwrite").option("header", True).csv(path)


def load_curve(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("position long, x double, y double").option("header", True).csv(path)
