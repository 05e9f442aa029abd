"""Grid search on prepared tables against plain refits, and thresholds against applied models."""

import random
from collections import Counter

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from petrichor.operators import curves, split
from petrichor.plans import learners, search
from petrichor.plans.presets import FeatureSet

FEATURES = FeatureSet(
    name="small", keys=("id",), label="target", numeric=("a", "b"), categorical=("c",), impute_mode=("c",), invalid="keep", label_order="alphabetAsc"
)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(6)
    out = []
    for i in range(600):
        a, b, c = rng.gauss(0, 1), rng.gauss(5, 2), rng.choice("xyz")
        target = "Y" if a + 0.3 * b + (c == "x") + rng.gauss(0, 1) > 2 else "N"
        out.append((i, None if rng.random() < 0.1 else a, b if i % 50 else 900.0, None if rng.random() < 0.1 else c, target))
    return spark.createDataFrame(out, "id long, a double, b double, c string, target string").cache()


def counting(monkeypatch):
    fits = Counter()
    prepare, fit = search.prepare, search._fit

    class Counted(Pipeline):
        def fit(self, df, params=None):
            fits["preparations"] += 1
            return super().fit(df, params)

    monkeypatch.setattr(search, "prepare", lambda features: Counted(stages=prepare(features).getStages()))
    monkeypatch.setattr(search, "_fit", lambda *a: (fits.update(["learners"]), fit(*a))[1])
    return fits


def by_hand(rows, point, fold, folds):
    """Everything fitted anew on the rows of the other folds."""
    placed = split.with_fold(rows, ["id"], folds).drop("target").join(rows.select("id", "target"), "id")
    stages = [*search.prepare(FEATURES).getStages(), learners.logistic_regression("medium", **point)]
    return Pipeline(stages=stages).fit(placed.where(f"fold <> {fold}")).transform(placed.where(f"fold = {fold}"))


def test_search_equals_refits_with_fewer_fits(rows, monkeypatch):
    fits = counting(monkeypatch)
    grid = {"regParam": [0.01, 0.4], "threshold": [0.3, 0.5, 0.7]}
    found = search.search(rows, FEATURES, learners.logistic_regression("medium"), grid, folds=3, metric="accuracy", cleaned=True)
    assert dict(fits) == found.fits == {"preparations": 4, "learners": 7}
    each = {(r.params, r.fold): r.metric for r in found.by_fold.collect()}
    assert len(each) == 18
    monkeypatch.undo()
    for reg in grid["regParam"]:
        for t in grid["threshold"]:
            applied = by_hand(rows, {"regParam": reg, "threshold": t}, 1, 3)
            right = applied.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
            assert each[f"regParam={reg}, threshold={t}", 1] == pytest.approx(right, abs=1e-12)
    table = found.results.orderBy("rank").collect()
    assert [r.rank for r in table] == list(range(1, 7)) and table[0].avg_metric == max(r.avg_metric for r in table)
    assert search.described(found.best) == table[0].params
    assert found.model.stages[-1].getThreshold() == found.best["threshold"]
    assert found.model.transform(rows).where("prediction is null").count() == 0


def test_search_by_area_equals_the_built_in_evaluator(rows):
    found = search.search(rows, FEATURES, learners.logistic_regression("medium"), {"regParam": [0.01, 2.0]}, folds=2, cleaned=True)
    each = {(r.params, r.fold): r.metric for r in found.by_fold.collect()}
    for reg in (0.01, 2.0):
        applied = by_hand(rows, {"regParam": reg}, 0, 2).coalesce(1)
        area = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0).evaluate(applied)
        assert each[f"regParam={reg}", 0] == pytest.approx(area, abs=1e-9)
    assert found.best["regParam"] in (0.01, 2.0) and found.fits == {"preparations": 3, "learners": 5}


def test_thresholds_of_one_model_equal_the_model_at_each(rows):
    stages = [*search.prepare(FEATURES).getStages(), learners.logistic_regression("medium")]
    model = Pipeline(stages=stages).fit(rows)
    pairs = learners.scored(model.transform(rows))
    thresholds = [0.0, 0.2, 0.5, 0.81, 1.0]
    cells = {r.threshold: r for r in curves.threshold_cells(curves.running_counts(pairs, "score"), thresholds).collect()}
    for t in thresholds:
        model.stages[-1].setThreshold(t)
        n = Counter((r.label, r.prediction) for r in model.transform(rows).select("label", "prediction").collect())
        assert (cells[t].tp, cells[t].fp, cells[t].tn, cells[t].fn) == (n[1, 1], n[0, 1], n[0, 0], n[1, 0])


def test_grouped_curves_equal_each_group_alone(spark):
    rng = random.Random(9)
    rows = [(g, "m%d" % (g % 2), round(rng.random(), 2), float(rng.random() < 0.4)) for g in (1, 2, 3) for _ in range(300 * g)]
    df = spark.createDataFrame(rows, "g int, m string, score double, label double")
    together = curves.curve(df, "score", num_bins=11, rows_per_range=20, by=["m", "g"])
    area = {(r.m, r.g): (r.auc_roc, r.auc_pr) for r in curves.areas(together, by=["m", "g"]).collect()}
    for g in (1, 2, 3):
        alone = curves.curve(df.where(f"g = {g}"), "score", num_bins=11)
        names = alone.columns
        assert sorted(map(tuple, together.where(f"g = {g}").select(*names).collect())) == sorted(map(tuple, alone.collect()))
        assert area["m%d" % (g % 2), g] == pytest.approx(tuple(curves.areas(alone).first()))


def test_search_refuses_what_it_cannot_do(rows):
    with pytest.raises(ValueError, match="metric"):
        search.search(rows, FEATURES, learners.decision_tree(), {"maxDepth": [1]}, metric="gain")
    with pytest.raises(ValueError, match="threshold"):
        search.search(rows, FEATURES, learners.decision_tree(), {"maxDepth": [1], "threshold": [0.5]})
    with pytest.raises(ValueError, match="both classes"):
        search.search(rows.where("target = 'Y'"), FEATURES, learners.decision_tree(), {"maxDepth": [1]}, folds=2, cleaned=True)
