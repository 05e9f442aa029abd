import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from petrichor.catalog.observations import scored_rows
from petrichor.operators import curves, evaluate
from petrichor.sources.sinks import load_curve, save_curve


@pytest.fixture(scope="module")
def rows(spark, small):
    return scored_rows(spark, small).cache()


def evaluator(rows, name, **kw):
    return MulticlassClassificationEvaluator(metricName=name, **kw).evaluate(rows)


def test_metrics_equal_the_evaluator(rows):
    error = evaluate.accuracy_error(rows).first()
    assert error.accuracy == pytest.approx(evaluator(rows, "accuracy"))
    assert evaluate.error_rate(rows).first().error_rate == pytest.approx(error.error)
    weighted = evaluate.weighted_metrics(rows).first()
    assert weighted.weighted_f1 == pytest.approx(evaluator(rows, "f1"))
    assert weighted.weighted_precision == pytest.approx(evaluator(rows, "weightedPrecision"))
    assert weighted.weighted_true_positive_rate == pytest.approx(evaluator(rows, "weightedTruePositiveRate"))
    assert weighted.weighted_false_positive_rate == pytest.approx(evaluator(rows, "weightedFalsePositiveRate"))
    for row in evaluate.class_metrics(rows).collect():
        for name, value in (
            ("truePositiveRateByLabel", row.true_positive_rate),
            ("falsePositiveRateByLabel", row.false_positive_rate),
            ("precisionByLabel", row.precision),
            ("fMeasureByLabel", row.f1),
        ):
            assert value == pytest.approx(evaluator(rows, name, metricLabel=row.label))


def test_three_classes(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (2, 0), (2, 2), (2, 2), (1, 2)]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")
    assert evaluate.weighted_metrics(df).first().weighted_f1 == pytest.approx(evaluator(df, "f1"))


def test_confusion_and_its_rates(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0)] * 4 + [(0.0, 1.0)] * 3 + [(0.0, 0.0)] * 2 + [(1.0, 0.0)], "label double, prediction double"
    )
    row = evaluate.confusion_rates(df).first()
    assert tuple(row)[:4] == (4, 3, 2, 1)
    assert row.accuracy == 0.6 and row.recall == 0.8 and row.false_positive_rate == 0.6
    assert row.precision == pytest.approx(4 / 7)
    assert tuple(evaluate.confusion_matrix(df, positive=0.0).first()) == (2, 1, 4, 3)
    interval = evaluate.error_confidence(df).first()
    assert interval.ci_ref_high - interval.error_rate == pytest.approx((0.4 * 0.6 / 1.96) ** 0.5)
    assert interval.error_rate - interval.ci95_low == pytest.approx(1.96 * (0.4 * 0.6 / 10) ** 0.5)
    none = evaluate.confusion_rates(df.filter("label = 0 and prediction = 0")).first()
    assert none.recall is None and none.precision is None


@pytest.mark.parametrize("score", ["score", "price", "prediction"])
@pytest.mark.parametrize("bins", [0, 15, 1000])
@pytest.mark.parametrize("rows_per_range", [10**6, 500])
def test_areas_equal_the_evaluator(rows, score, bins, rows_per_range):
    one = rows.coalesce(1)  # the built-in bins within partitions
    points = curves.areas(curves.curve(rows, score, num_bins=bins, rows_per_range=rows_per_range)).first()
    for name, value in (("areaUnderROC", points.auc_roc), ("areaUnderPR", points.auc_pr)):
        built_in = BinaryClassificationEvaluator(rawPredictionCol=score, metricName=name, numBins=bins)
        if bins == 0 or one.select(score).distinct().count() < 2 * bins:
            assert value == pytest.approx(built_in.evaluate(one), abs=1e-12)
        else:
            # Its sort leaves several partitions, each with a remainder bin.
            assert value == pytest.approx(built_in.evaluate(one), abs=2e-3)


def brute_points(pairs, bins):
    scores = sorted({s for s, _ in pairs}, reverse=True)
    width = max(1, len(scores) // bins) if bins and len(scores) // bins >= 2 else 1
    points, tp, fp = [], 0, 0
    for i in range(0, len(scores), width):
        chosen = set(scores[i : i + width])
        tp += sum(l for s, l in pairs if s in chosen)
        fp += sum(1 - l for s, l in pairs if s in chosen)
        points.append((min(chosen), tp, fp))
    return points


@pytest.mark.parametrize("bins", [0, 4, 15])
@pytest.mark.parametrize("rows_per_range", [10**6, 60])
def test_curve_against_brute_force(spark, bins, rows_per_range):
    rng = random.Random(bins)
    # A third of the rows share one score.
    pairs = [(0.5 if i % 3 == 0 else round(rng.random(), 2), rng.randint(0, 1)) for i in range(600)]
    df = spark.createDataFrame([(s, float(l)) for s, l in pairs] + [(None, 1.0), (0.1, None)], "score double, label double")
    found = curves.curve(df, "score", num_bins=bins, rows_per_range=rows_per_range).orderBy("bin").collect()
    assert [(r.score, r.tp, r.fp) for r in found] == brute_points(pairs, bins)
    assert [r.bin for r in found] == list(range(len(found)))


def test_curve_shapes(rows):
    points = curves.curve(rows, "score", num_bins=15)
    roc = curves.roc_curve(points).orderBy("position").collect()
    assert (roc[0].x, roc[0].y) == (0.0, 0.0) and (roc[-1].x, roc[-1].y) == (1.0, 1.0)
    assert [r.position for r in roc] == list(range(len(roc)))
    assert all(a.x <= b.x and a.y <= b.y for a, b in zip(roc, roc[1:]))
    pr = curves.pr_curve(points).orderBy("position").collect()
    assert pr[0].x == 0.0 and pr[0].y == pr[1].y and pr[-1].x == 1.0
    area = curves.areas(curves.curve(rows, "score")).first().auc_roc
    turned = curves.areas(curves.curve(rows.withColumn("score", -F.col("score")), "score")).first().auc_roc
    assert area + turned == pytest.approx(1.0)


def test_curve_without_scores(spark):
    df = spark.createDataFrame([], "score double, label double")
    assert curves.curve(df, "score").count() == 0


def test_ranges_need_no_single_task_over_scores(spark, small):
    # Read apart from the cached rows of the other tests.
    df = spark.read.parquet(f"{small}/lineitem.parquet").select(
        F.col("l_extendedprice").alias("price"), (F.col("l_linestatus") == "O").cast("int").alias("label")
    )
    points = curves.curve(df, "price", rows_per_range=500)
    points.collect()
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("binned", [True, False])
def test_curve_sink(spark, rows, tmp_path, binned):
    roc = curves.roc_curve(curves.curve(rows, "score", num_bins=15 if binned else 0))
    save_curve(roc, str(tmp_path / "roc"), binned)
    back = load_curve(spark, str(tmp_path / "roc"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, roc.collect()))
    if binned:
        assert len(list((tmp_path / "roc").glob("part-*"))) == 1
