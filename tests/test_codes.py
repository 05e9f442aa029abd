"""Codes kept as a table, and all category facts from one counting pass."""

import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from petrichor.operators import codes, encode
from petrichor.operators.impute import DomainModeImputer, ModeImputer

COLUMNS = ["flag", "place", "month"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    out = []
    for i in range(800):
        flag = rng.choice(["NA", None, "a", "b", "b", "null", "é", "Z"])
        out.append((i, flag, rng.choice(["S1", "S10", "S2", "NA"]), rng.choice([None, 1, 2, 10, 11]), rng.choice([0, 3, 3, 9, 77, None]), rng.choice(["Yes", "No", "No"])))
    return spark.createDataFrame(out, "id int, flag string, place string, month int, cloud int, target string").cache()


def one_by_one(order, label_order, invalid):
    return Pipeline(stages=[
        ModeImputer(inputCols=["flag"]), DomainModeImputer(inputCols=["cloud"], lowest=0, highest=8),
        encode.string_indexer(COLUMNS, order, invalid), encode.label_indexer("target", label_order),
    ])


@pytest.mark.parametrize("order,label_order,invalid", [
    ("alphabetDesc", "alphabetAsc", "skip"), ("frequencyDesc", "frequencyDesc", "keep"), ("frequencyAsc", "frequencyAsc", "keep"), ("alphabetAsc", "alphabetDesc", "skip"),
])
def test_one_pass_equals_separate_stages(rows, order, label_order, invalid):
    together = codes.CategoryPreparation(
        inputCols=COLUMNS, modeCols=["flag"], domainCols=["cloud"], lowest=[0], highest=[8], label="target", labelOrder=label_order, order=order, invalid=invalid
    )
    names = ["id", "flag", "place", "month", "cloud", "target", "flag_num", "place_num", "month_num", "label"]
    found = together.fit(rows).transform(rows).select(names)
    expected = one_by_one(order, label_order, invalid).fit(rows).transform(rows).select(names)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def test_counts_of_codes_are_those_of_the_imputed_column(rows):
    model = codes.CategoryPreparation(inputCols=["flag", "cloud"], modeCols=["flag"], domainCols=["cloud"], lowest=[0], highest=[8]).fit(rows)
    got = {(r.column, r.value): r.n for r in model.stages[-1].codes().collect()}
    filled = model.transform(rows)
    expected = {(c, str(r[c])): r["count"] for c in ("flag", "cloud") for r in filled.groupBy(c).count().collect()}
    assert got == expected


@pytest.mark.parametrize("highest", [8, 2])
def test_a_mode_outside_its_range_is_a_category(rows, highest):
    model = codes.CategoryPreparation(inputCols=["cloud"], domainCols=["cloud"], lowest=[0], highest=[highest], order="frequencyDesc").fit(rows)
    out = model.transform(rows)
    expected = Pipeline(stages=[DomainModeImputer(inputCols=["cloud"], lowest=0, highest=highest), encode.string_indexer(["cloud"], "frequencyDesc")])
    pick = lambda df: sorted((r.id, r.cloud, r.cloud_num) for r in df.select("id", "cloud", "cloud_num").collect())
    assert pick(out) == pick(expected.fit(rows).transform(rows))
    assert model.stages[-1].getOrDefault("sizes") == [out.select("cloud").distinct().count()]


def test_saved_codes_are_exact(spark, rows, tmp_path):
    stages = [codes.CategoryCoder(inputCols=COLUMNS, invalid="keep"), encode.one_hot_encoder(COLUMNS), encode.assembler([c + "_hot" for c in COLUMNS])]
    model = Pipeline(stages=stages).fit(rows)
    model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    coder = again.stages[0]
    assert coder.getOrDefault("path").startswith(str(tmp_path)) and coder.getOrDefault("sizes") == model.stages[0].getOrDefault("sizes")
    assert sorted(map(tuple, coder.codes().collect())) == sorted(map(tuple, model.stages[0].codes().collect()))
    pick = lambda m: sorted((r.id, r.v) for r in m.transform(rows).select("id", vector_to_array("features").alias("v")).collect())
    assert pick(model) == pick(again)
    old = Pipeline(stages=[encode.string_indexer(COLUMNS, invalid="keep"), *stages[1:]]).fit(rows)
    assert pick(old) == pick(again)


def test_null_and_unseen_categories(spark, rows):
    train = rows.where("flag in ('a', 'b')")
    fit = lambda invalid: codes.CategoryCoder(inputCols=["flag"], order="alphabetAsc", invalid=invalid).fit(train)
    assert fit("skip").transform(rows).count() == train.count()
    kept = fit("keep").transform(rows)
    assert {(r.flag, r.flag_num) for r in kept.select("flag", "flag_num").collect()} == {("a", 0), ("b", 1), ("NA", 2), (None, 2), ("null", 2), ("é", 2), ("Z", 2)}
    assert kept.schema["flag_num"].metadata["ml_attr"] == {"type": "nominal", "name": "flag_num", "num_vals": 3}
    with pytest.raises(Exception, match="unseen or missing category in flag"):
        fit("error").transform(rows).collect()
    with pytest.raises(ValueError, match="invalid must be"):
        codes.CategoryCoder(inputCols=["flag"], invalid="drop")
    with pytest.raises(ValueError, match="no values"):
        codes.CategoryPreparation(modeCols=["flag"]).fit(rows.where("flag is null"))
    none = codes.CategoryCoder(inputCols=["flag"], invalid="keep").fit(rows.where("false"))
    assert {r.flag_num for r in none.transform(rows).select("flag_num").collect()} == {0.0}
    named = fit("keep").texts(spark.range(3).select(F.col("id").cast("double").alias("k")), "flag", "k", "text").collect()
    assert sorted((r.k, r.text) for r in named) == [(0.0, "a"), (1.0, "b"), (2.0, None)]


def test_a_million_categories(spark, tmp_path):
    many = spark.range(1_000_000).select(F.format_string("c%07d", "id").alias("c"), "id")
    model = PipelineModel([codes.CategoryCoder(inputCols=["c"], order="alphabetAsc").fit(many)])
    model.write().save(str(tmp_path / "many"))
    again = PipelineModel.load(str(tmp_path / "many"))
    assert again.stages[0].getOrDefault("sizes") == [1_000_000]
    out = again.transform(many)
    assert out.where("c_num = id").count() == 1_000_000
    assert "Broadcast" not in out.where("c_num = id")._jdf.queryExecution().optimizedPlan().toString()


def test_one_pass_takes_few_jobs(spark, rows):
    tracker, group = spark.sparkContext.statusTracker(), "category jobs"
    spark.sparkContext.setJobGroup(group, "")
    codes.CategoryPreparation(inputCols=COLUMNS, modeCols=["flag"], domainCols=["cloud"], lowest=[0], highest=[8], label="target", invalid="keep").fit(rows)
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 10  # one for each shuffle and each result
