"""Grid search over tables that are prepared once.

Imputation values and codes are fitted once for each fold, on its training side,
and the vectors of both sides are written once. All grid points learn from those
tables, several at a time, and write their scores; the areas of every model then
come from one set of curves, and every threshold of a model is read from its
running counts. A threshold of the grid costs no fit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..operators import curves
from ..operators.split import with_fold
from ..session import landed, shared_dir
from .learners import scored
from .presets import FeatureSet
from .workflow import clean, preparation

AREAS = ("auc_roc", "auc_pr")
RATES = ("accuracy", "f1")
_BY = ["fold", "point"]


@dataclass
class Searched:
    """``results``: (rank, params, avg_metric, std_metric), best first. ``by_fold``: (params, fold, metric).
    ``fits``: how many preparations and learners were fitted, the final model's included."""

    results: DataFrame
    by_fold: DataFrame
    best: dict[str, object]
    model: PipelineModel
    fits: dict[str, int]


def described(point: Mapping[str, object]) -> str:
    return ", ".join(f"{k}={point[k]}" for k in sorted(point))


def points_of(grid: Mapping[str, Sequence]) -> list[dict[str, object]]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def prepare(features: FeatureSet) -> Pipeline:
    """Imputation, codes, vector and class."""
    return preparation(features, labelled=True)


def _all(spark, parallelism: int, task, arguments: Sequence[tuple]) -> list:
    """Results of jobs that are submitted side by side, in the order of their arguments."""
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        return [job.result() for job in [pool.submit(inheritable_thread_target(spark)(task), *a) for a in arguments]]


def fold_tables(rows: DataFrame, features: FeatureSet, folds: int, fold_column: str, parallelism: int = 4) -> list[DataFrame]:
    """For each fold (_held, label, features) of all rows, prepared by what the other folds teach; written once."""

    def table(fold: int) -> DataFrame:
        held = F.col(fold_column) == fold
        ready = prepare(features).fit(rows.where(~held)).transform(rows.withColumn("_held", held))
        return landed(ready.select("_held", "label", "features"), f"vectors-{fold}", partition_by="_held")

    return _all(rows.sparkSession, parallelism, table, [(fold,) for fold in range(folds)])


def _fit(learner: Estimator, point: Mapping[str, object], train: DataFrame):
    settings = {learner.getParam(k): v for k, v in point.items()}
    return learner.copy(settings).fit(train)


def _scores(tables: list[DataFrame], learner: Estimator, fitted: list[dict], parallelism: int) -> DataFrame:
    """(score, prediction, label, fold, point) of every held-out row under every point."""
    spark = tables[0].sparkSession
    path = shared_dir(spark, "search-scores")

    def run(fold: int, number: int) -> None:
        model = _fit(learner, fitted[number], tables[fold].where("not _held"))
        pairs = scored(model.transform(tables[fold].where("_held")))
        pairs.write.parquet(f"{path}/fold={fold}/point={number}")

    _all(spark, parallelism, run, [(f, p) for f in range(len(tables)) for p in range(len(fitted))])
    schema = "score double, prediction double, label double, fold int, point int"
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def _rate(metric: str):
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    return F.try_divide(tp + tn, tp + fp + tn + fn) if metric == "accuracy" else F.try_divide(2 * tp, 2 * tp + fp + fn)


def _measured(scores: DataFrame, metric: str, thresholds: Sequence[float]) -> DataFrame:
    """(fold, point, threshold, metric), at most folds x points x thresholds rows."""
    if metric in AREAS:
        found = curves.areas(curves.curve(scores, "score", by=_BY), by=_BY).withColumn("metric", F.col(metric))
        own = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])) if thresholds else F.lit(None).cast("double")
        return found.withColumn("threshold", own).select(*_BY, "threshold", "metric")
    if thresholds:
        cells = curves.threshold_cells(curves.running_counts(scores, "score", by=_BY), thresholds, by=_BY)
    else:
        hit = lambda p, y: F.count_if((F.col("prediction") == p) & (F.col("label") == y))
        cells = scores.groupBy(*_BY).agg(hit(1, 1).alias("tp"), hit(1, 0).alias("fp"), hit(0, 0).alias("tn"), hit(0, 1).alias("fn"))
        cells = cells.withColumn("threshold", F.lit(None).cast("double"))
    return cells.withColumn("metric", _rate(metric)).select(*_BY, "threshold", "metric")


def search(
    df: DataFrame,
    features: FeatureSet,
    learner: Estimator,
    grid: Mapping[str, Sequence],
    folds: int = 5,
    metric: str = "auc_roc",
    parallelism: int = 4,
    seed: int = 0,
    cleaned: bool = False,
) -> Searched:
    """Find the grid point with the best average of ``metric`` over the folds, and train it on all rows.

    ``grid`` names the learner's parameters. ``threshold`` is no fit of its own: a model
    without it is scored once and read at every threshold. Metrics are ``auc_roc``,
    ``auc_pr`` (the same at every threshold), ``accuracy`` and ``f1`` of class 1. Folds are
    hashes of the feature set's keys, so rows with equal keys share one. Ties go to the
    smaller text of the parameters. A fold without both classes has no area and does not
    count. ``df`` is cleaned first unless it is already.
    """
    if metric not in AREAS + RATES:
        raise ValueError(f"metric must be one of {', '.join(AREAS + RATES)}, not {metric!r}")
    if "threshold" in grid and not learner.hasParam("threshold"):
        raise ValueError(f"{type(learner).__name__} has no threshold")
    rows = df if cleaned else clean(df, features)
    rows = landed(with_fold(rows, features.keys, folds, seed, "_fold"), "search-rows")
    tables = fold_tables(rows, features, folds, "_fold", parallelism)
    thresholds = [float(t) for t in grid.get("threshold", ())]
    fitted = points_of({k: v for k, v in grid.items() if k != "threshold"})
    measured = _measured(_scores(tables, learner, fitted, parallelism), metric, thresholds).collect()

    spark, found = rows.sparkSession, {}
    for row in measured:
        point = fitted[row["point"]] | ({"threshold": row["threshold"]} if thresholds else {})
        if row["metric"] is not None:
            found.setdefault(described(point), (point, {}))[1][row["fold"]] = row["metric"]
    if not found:
        raise ValueError("no fold has rows of both classes")
    ranked = []
    for params, (point, values) in found.items():
        average = sum(values.values()) / len(values)
        spread = sum((v - average) ** 2 for v in values.values()) / max(1, len(values) - 1)
        ranked.append((-average, params, spread**0.5, point))
    ranked.sort(key=lambda r: r[:2])
    results = [(i + 1, params, -average, spread) for i, (average, params, spread, _) in enumerate(ranked)]
    each = [(params, fold, value) for params, (_, values) in found.items() for fold, value in sorted(values.items())]

    best = ranked[0][3]
    rows = rows.drop("_fold")
    prepared = prepare(features).fit(rows)
    whole = landed(prepared.transform(rows).select("label", "features"), "search-vectors")
    model = PipelineModel([*prepared.stages, _fit(learner, best, whole)])
    return Searched(
        spark.createDataFrame(results, "rank int, params string, avg_metric double, std_metric double"),
        spark.createDataFrame(each, "params string, fold int, metric double"),
        best,
        model,
        {"preparations": folds + 1, "learners": folds * len(fitted) + 1},
    )
