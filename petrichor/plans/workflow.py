"""The whole way: clean, split, prepare, train, store, score, evaluate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, functions as F

from ..operators import curves, evaluate as metrics
from ..operators.clean import (
    audit_of,
    counted_keys,
    dedupe_by_key,
    drop_columns,
    drop_empty_rows,
    drop_unlabelled,
    replace_sentinel,
)
from ..operators.codes import CategoryPreparation
from ..operators.encode import assembler, one_hot_encoder
from ..operators.impute import IqrCapImputer
from ..operators.split import side_of
from ..functions.columns import month_of
from ..session import landed
from ..sources.sinks import save_model
from .learners import fit_prepared, scored
from .presets import FeatureSet


def select_and_null(df: DataFrame, features: FeatureSet) -> DataFrame:
    """Prune columns and turn the sentinel into NULL, except in key columns."""
    df = drop_columns(df, features.drop)
    return replace_sentinel(df, [c for c in df.columns if c not in features.keys])


def clean(df: DataFrame, features: FeatureSet, labelled: bool = True) -> DataFrame:
    """One row per key, none empty, each with a class; the month derived."""
    df = drop_empty_rows(dedupe_by_key(select_and_null(df, features), features.keys))
    if labelled:
        df = drop_unlabelled(df, features.label)
    return df.withColumn(features.month, month_of(features.date)) if features.date else df


def keyed_sides(df: DataFrame, features: FeatureSet, weights: Sequence[float] = (0.7, 0.3), seed: int = 0) -> DataFrame:
    """One row per key with ``_copies`` and the ``_side`` it falls on, written once, by side.

    Rows with equal keys share a side. Keys with a NULL part are one key, which goes
    where its surviving row goes, so audits and rows of a side always agree.
    """
    keyed = counted_keys(select_and_null(df, features), features.keys)
    return landed(keyed.withColumn("_side", side_of(features.keys, weights, seed)), "keys", partition_by="_side")


def rows_of_sides(keyed: DataFrame, features: FeatureSet, sides: int) -> list[DataFrame]:
    """The cleaned rows of each side of a ``keyed_sides`` table."""
    rows = drop_unlabelled(drop_empty_rows_of(keyed), features.label)
    if features.date:
        rows = rows.withColumn(features.month, month_of(features.date))
    return [rows.filter(F.col("_side") == i).drop("_side", "_copies") for i in range(sides)]


def drop_empty_rows_of(keyed: DataFrame) -> DataFrame:
    """A ``keyed_sides`` table without the rows that hold nothing but its own columns."""
    return keyed.na.drop("all", subset=[c for c in keyed.columns if c not in ("_side", "_copies")])


def audits_of_sides(keyed: DataFrame, features: FeatureSet) -> DataFrame:
    """The cleaning audit of every side of a ``keyed_sides`` table, in one pass."""
    columns = [c for c in keyed.columns if c not in ("_side", "_copies")]
    return audit_of(keyed, columns, features.label, by=["_side"])


def clean_sides(
    df: DataFrame, features: FeatureSet, weights: Sequence[float] = (0.7, 0.3), seed: int = 0
) -> list[DataFrame]:
    """Cleaned rows, split by key; the fitting passes read the columns they need."""
    return rows_of_sides(keyed_sides(df, features, weights, seed), features, len(weights))


def preparation_stages(features: FeatureSet, labelled: bool = False) -> list[Estimator]:
    """Imputation, encoding and assembly, learned from the training rows; with
    ``labelled`` the class index too. All category facts share one pass."""
    stages: list[Estimator] = []
    if features.numeric:
        stages.append(IqrCapImputer(inputCols=list(features.numeric)))
    if features.impute_mode or features.domain or features.categorical or labelled:
        stages.append(
            CategoryPreparation(
                inputCols=list(features.categorical),
                modeCols=list(features.impute_mode),
                domainCols=list(features.domain),
                lowest=[low for low, _ in features.domain.values()],
                highest=[high for _, high in features.domain.values()],
                label=features.label if labelled else "",
                labelOrder=features.label_order,
                invalid=features.invalid,
            )
        )
    if features.categorical and features.one_hot:
        stages.append(one_hot_encoder(features.categorical))
    stages.append(assembler(features.vector_inputs))
    return stages


def preparation(features: FeatureSet, labelled: bool = False) -> Pipeline:
    return Pipeline(stages=preparation_stages(features, labelled))


def pipeline(features: FeatureSet, learner: Estimator) -> Pipeline:
    return Pipeline(stages=[*preparation_stages(features, labelled=True), learner])


def flat_stages(model: PipelineModel) -> list:
    """The fitted stages in order, those of inner pipelines in their place."""
    return [x for s in model.stages for x in (flat_stages(s) if isinstance(s, PipelineModel) else [s])]


@dataclass
class Trained:
    """``audits`` has one table for each side; ``sides`` are their rows, of which the first two are ``train`` and ``test``."""

    model: PipelineModel
    train: DataFrame
    test: DataFrame
    predictions: DataFrame
    audits: tuple[DataFrame, ...]
    sides: tuple[DataFrame, ...] = ()


def train(
    df: DataFrame,
    features: FeatureSet,
    learner: Estimator,
    model_path: str | None = None,
    weights: Sequence[float] = (0.7, 0.3),
    seed: int = 0,
) -> Trained:
    """Clean, split by key into two sides or more, fit on the first and score the second."""
    if len(weights) < 2:
        raise ValueError("training needs two sides at least")
    keyed = keyed_sides(df, features, weights, seed)
    audits = audits_of_sides(keyed, features)
    sides = rows_of_sides(keyed, features, len(weights))
    model = fit_prepared(preparation_stages(features, labelled=True), learner, sides[0])
    if model_path:
        save_model(model, model_path)
    each = tuple(audits.filter(F.col("_side") == i).drop("_side") for i in range(len(weights)))
    return Trained(model, sides[0], sides[1], model.transform(sides[1]), each, tuple(sides))


def score(df: DataFrame, features: FeatureSet, model: PipelineModel) -> DataFrame:
    """Clean rows and score every one with stored values and codes.

    Rows need no class. The one they have becomes ``label`` by the stored codes,
    NULL if they have none or one that training never met.
    """
    rows = clean(df, features, labelled=False)
    for stage in flat_stages(model):
        if isinstance(stage, StringIndexerModel) and stage.isSet("inputCol") and stage.getInputCol() == features.label:
            codes = [F.lit(float(i)) for i in range(len(stage.labels))]
            pairs = [v for text, code in zip(stage.labels, codes) for v in (F.lit(text), code)]
            table = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
            rows = rows.withColumn(stage.getOutputCol(), F.try_element_at(table, F.col(features.label).cast("string")))
        else:
            rows = stage.transform(rows)
    return rows


def evaluate(predictions: DataFrame, num_bins: int = 15) -> dict[str, DataFrame]:
    """All evaluation tables. The scores are written once, so the model runs
    once however many tables are read."""
    pairs = landed(scored(predictions), "scores")
    points = curves.curve(pairs, "score", num_bins=num_bins)
    return {
        "accuracy": metrics.accuracy_error(pairs),
        "confusion": metrics.confusion_rates(pairs),
        "by_class": metrics.class_metrics(pairs),
        "weighted": metrics.weighted_metrics(pairs),
        "confidence": metrics.error_confidence(pairs),
        "stddev": pairs.agg(F.stddev("prediction").alias("stddev")),
        "areas": curves.areas(points),
        "roc": curves.roc_curve(points),
        "pr": curves.pr_curve(points),
    }
