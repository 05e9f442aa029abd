import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from petrichor.catalog import registry
from petrichor.operators import encode, split
from petrichor.plans import learners, presets, workflow
from petrichor.session import landed, shared_dir
from petrichor.sources.delimited import WEATHER_SCHEMA, read_delimited
from petrichor.sources.sinks import load_model

PLACES = ["Albury", "Bendigo", "Cairns"]
WINDS = ["N", "S", "E", "W"]


@pytest.fixture(scope="module")
def weather(spark, tmp_path_factory):
    """Invented days with a class that humidity decides, plus dirt: missing
    values, outliers, repeated days, unlabelled days, an empty line."""
    rng = random.Random(1)
    names = [f.split()[0] for f in WEATHER_SCHEMA.split(", ")]
    kinds = [f.split()[1] for f in WEATHER_SCHEMA.split(", ")]
    lines = [",".join(names)]
    for i in range(600):
        wet = rng.random() < 0.4
        row = {}
        for name, kind in zip(names, kinds):
            row[name] = f"{rng.gauss(15, 4):.1f}" if kind == "double" else str(rng.randint(0, 8))
        row.update(
            Date=f"2015-{i // 28 % 12 + 1:02d}-{i % 28 + 1:02d}",
            Location=PLACES[i // 336],
            WindGustDir=rng.choice(WINDS),
            WindDir9am=rng.choice(WINDS),
            WindDir3pm=rng.choice(WINDS),
            RainToday=rng.choice(["Yes", "No"]),
            Humidity3pm=str(rng.randint(55, 100) if wet else rng.randint(5, 60)),
            RainTomorrow="Yes" if wet else "No",
        )
        for name in names[2:]:
            if rng.random() < 0.04:
                row[name] = "NA"
        if rng.random() < 0.03:
            row["Rainfall"], row["Cloud9am"] = "900.0", "77"
        lines.append(",".join(row[n] for n in names))
    lines += lines[1:20] + ["," * (len(names) - 1)]
    path = tmp_path_factory.mktemp("weather") / "days.csv"
    path.write_text("\n".join(lines) + "\n")
    return read_delimited(spark, str(path), WEATHER_SCHEMA)


def test_presets():
    assert presets.MIXED15.vector_inputs == [
        "MinTemp", "MaxTemp", "Rainfall", "WindGustSpeed", "WindSpeed9am", "WindSpeed3pm", "Humidity9am",
        "Humidity3pm", "Pressure9am", "Month_num", "Location_num", "WindGustDir_num", "WindDir9am_num",
        "WindDir3pm_num", "RainToday_num",
    ]
    assert len(presets.ONEHOT5.vector_inputs) == 5 and len(presets.NUMERIC9.vector_inputs) == 9
    assert len(presets.DATE_CATEGORY.vector_inputs) == 22


@pytest.mark.parametrize("name", list(presets.PRESETS))
def test_every_preset_prepares_whole_vectors(weather, name):
    features = presets.PRESETS[name]
    rows = workflow.clean(weather, features)
    assert rows.count() == rows.select("Date", "Location").distinct().count()
    out = workflow.preparation(features).fit(rows).transform(rows)
    assert out.count() == rows.count()
    if features.numeric:
        assert out.filter(" or ".join(f"{c} is null" for c in features.numeric)).count() == 0
        assert out.agg(F.max("Rainfall")).first()[0] < 900
    if features.domain:
        assert out.filter("not Cloud9am between 0 and 8 or Cloud9am is null").count() == 0
    sizes = out.select(F.size(vector_to_array("features")).alias("n")).distinct().collect()
    assert len(sizes) == 1


def test_class_order_of_the_presets(weather):
    orders = {}
    for name in ("onehot5", "mixed15", "numeric9"):
        features = presets.PRESETS[name]
        rows = workflow.clean(weather, features)
        model = encode.label_indexer(features.label, features.label_order).fit(rows)
        orders[name] = model.labels
    assert orders == {"onehot5": ["Yes", "No"], "mixed15": ["No", "Yes"], "numeric9": ["No", "Yes"]}


def test_train_store_score_evaluate(spark, weather, tmp_path):
    path = str(tmp_path / "model")
    trained = workflow.train(weather, presets.MIXED15, learners.logistic_regression("selected"), path)
    audits = [a.first() for a in trained.audits]
    assert sum(a.total_rows for a in audits) == weather.count()
    assert [a.kept_rows for a in audits] == [trained.train.count(), trained.test.count()]
    tables = workflow.evaluate(trained.predictions)
    majority = trained.test.groupBy("RainTomorrow").count().agg(F.max("count") / F.sum("count")).first()[0]
    assert tables["accuracy"].first().accuracy > majority + 0.1
    area = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0).evaluate(
        trained.predictions.coalesce(1)
    )
    assert area > 0.85 and tables["areas"].first().auc_roc == pytest.approx(area, abs=0.02)
    assert tables["confusion"].first().tp == tables["by_class"].filter("label = 1").first().tp
    for name in ("weighted", "confidence", "stddev", "roc", "pr"):
        assert tables[name].count() > 0

    again = workflow.score(weather, presets.MIXED15, load_model(path))
    scores = {(r.Date, r.Location): r.score for r in learners.scored(again, "Date", "Location").collect()}
    for row in learners.scored(trained.predictions, "Date", "Location").collect():
        assert scores[row.Date, row.Location] == row.score

    named = learners.coefficients(spark, trained.model, presets.MIXED15.vector_inputs).collect()
    assert [r.feature for r in named] == ["intercept", *presets.MIXED15.vector_inputs]
    assert named[0].coefficient == 0.0
    # Coefficients are per unit of the capped columns: weigh them by spread.
    numeric = presets.MIXED15.numeric
    spread = trained.model.stages[0].transform(trained.train).agg(*[F.stddev(c).alias(c) for c in numeric]).first()
    effect = {r.feature: abs(r.coefficient) * spread[r.feature] for r in named if r.feature in numeric}
    assert max(effect, key=effect.get) == "Humidity3pm"


@pytest.mark.parametrize("setting", ["default", "bins49", "entropy_9_150", "entropy_11_2"])
def test_trees_on_one_hot_features(weather, setting):
    rows = workflow.clean(weather, presets.ONEHOT5)
    learner = learners.decision_tree(setting)
    model = workflow.pipeline(presets.ONEHOT5, learner).fit(rows)
    assert model.transform(rows).select("prediction").distinct().count() >= 1
    assert model.stages[-1].depth <= learner.getMaxDepth()


def test_too_few_bins_for_a_category(weather):
    rows = workflow.clean(weather, presets.DATE_CATEGORY)
    with pytest.raises(Exception, match="maxBins"):
        workflow.pipeline(presets.DATE_CATEGORY, learners.decision_tree()).fit(rows)
    assert workflow.pipeline(presets.DATE_CATEGORY, learners.decision_tree("dates")).fit(rows).stages[-1].numNodes > 1


def test_forest_search(spark, weather):
    rows = workflow.preparation(presets.NUMERIC9).fit(
        clean := workflow.clean(weather, presets.NUMERIC9)
    ).transform(clean)
    rows = split.with_fold(rows.drop("features"), ["Date", "Location"], 3)
    forest = learners.random_forest("shallow")
    stages = [encode.assembler(presets.NUMERIC9.numeric), encode.label_indexer("RainTomorrow", "frequencyDesc"), forest]
    grid = learners.parameter_grid(forest, {"maxBins": [42], "maxDepth": [1, 4], "impurity": ["gini"]})
    model = learners.cross_validate(rows, Pipeline(stages=stages), grid, folds=3, fold_column="fold")
    table = learners.cv_results(spark, model).orderBy("rank").collect()
    assert len(table) == 2 and table[0].avg_metric >= table[1].avg_metric > 0.7
    best = learners.best_params(model)
    assert best["maxBins"] == 42 and f"maxDepth={best['maxDepth']}" in table[0].params
    again = learners.cross_validate(rows, Pipeline(stages=stages), grid, folds=3, fold_column="fold")
    assert again.avgMetrics == pytest.approx(model.avgMetrics)


def test_grids_have_the_published_sizes():
    sizes = {"forest_small": 4, "forest_large": 18, "regression_small": 6, "regression_large": 192}
    for name, size in sizes.items():
        learner = learners.random_forest() if name.startswith("forest") else learners.logistic_regression()
        grid = learners.parameter_grid(learner, learners.GRIDS[name])
        assert len(grid) == size == len({tuple(sorted((p.name, str(v)) for p, v in point.items())) for point in grid})


def test_settings_reach_the_learners():
    lr = learners.logistic_regression("selected")
    assert (lr.getMaxIter(), lr.getRegParam(), lr.getElasticNetParam(), lr.getFitIntercept()) == (100, 0.01, 0.5, False)
    assert learners.random_forest("deep").getMaxDepth() == 10
    assert learners.random_forest("shallow", numTrees=3).getNumTrees() == 3
    assert learners.decision_tree("entropy_9_2").getImpurity() == "entropy"


def test_intermediate_tables(spark):
    df = landed(spark.range(10).withColumn("side", F.col("id") % 2), "t", partition_by="side")
    assert df.filter("side = 1").count() == 5 and df.columns == ["id", "side"]
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_audits_of_null_keys_and_of_three_sides_agree_with_the_rows(weather):
    rows = weather.withColumn("Location", F.when(F.col("Humidity9am") > 3, F.col("Location")))
    trained = workflow.train(rows, presets.NUMERIC9, learners.decision_tree(), weights=(0.5, 0.3, 0.2))
    audits = [a.first() for a in trained.audits]
    assert [a.kept_rows for a in audits] == [s.count() for s in trained.sides] and len(audits) == 3
    assert sum(a.total_rows for a in audits) == rows.count()
    with pytest.raises(ValueError, match="two sides"):
        workflow.train(rows, presets.NUMERIC9, learners.decision_tree(), weights=(1.0,))


@pytest.mark.parametrize("kind,setting", [("decision_tree", "bins49"), ("logistic_regression", "selected"), ("random_forest", "deep")])
def test_published_settings_on_the_observations(spark, small, kind, setting):
    """Their class has nothing to do with the features, so only shape and sanity can be told."""
    trained = registry.train_observations(spark, small, getattr(learners, kind)(setting))
    report = registry._report("x", trained.predictions).first()
    assert report.tp + report.fp + report.tn + report.fn == trained.predictions.count() > 500
    assert 0.3 < report.accuracy < 0.7 and 0.3 < report.auc_roc < 0.7


def test_learners_get_rows_in_many_parts(spark, monkeypatch):
    """However few the input's parts are, no task learns from much more than its share, and folds are prepared once each."""
    monkeypatch.setattr(learners, "TASK_ROWS", 100)
    rows = spark.range(1, 1001, numPartitions=1).selectExpr("id", "id % 7 AS a", "id % 7 > 3 AS big", "id % 5 AS fold")
    rows = rows.selectExpr("id", "double(a) AS a", "if(big, 'y', 'n') AS target", "int(fold) AS fold")
    seen, fits = [], []

    class Learner(learners.DecisionTreeClassifier):
        def _fit(self, df):
            seen.append(max(r["n"] for r in df.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).collect()))
            return super()._fit(df)

    class Assembler(encode.VectorAssembler):
        def transform(self, df, params=None):
            fits.append(1)
            return super().transform(df, params)

    stages = [Assembler(inputCols=["a"], outputCol="features"), encode.label_indexer("target", "frequencyDesc")]
    learner = Learner(maxDepth=3, seed=1)
    grid = learners.parameter_grid(learner, {"maxDepth": [1, 2], "maxBins": [8, 16]})
    model = learners.cross_validate(rows, Pipeline(stages=[*stages, learner]), grid, folds=5, fold_column="fold")
    assert model.avgMetrics == [1.0] * 4 and model.stdMetrics == [0.0] * 4 and len(model.getEstimatorParamMaps()) == 4
    assert len(seen) == 21 and max(seen) <= 101
    # one for the training side, one for the stages behind it, one for the held-out side; the last fit has no held-out side
    assert len(fits) <= 3 * 5 + 2
    with pytest.raises(ValueError):
        learners.cross_validate(rows.where("fold < 4"), Pipeline(stages=[*stages, learner]), grid, folds=5, fold_column="fold")
