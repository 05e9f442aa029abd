import math
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from petrichor.operators import stats
from petrichor.operators.impute import DomainModeImputer, IqrCapImputer, ModeImputer


def numbers(spark, values, partitions=3):
    return spark.createDataFrame([(v,) for v in values], "v double").repartition(partitions)


@pytest.mark.parametrize(
    "values, expected",
    [
        ([*range(1, 11), None], [3, 5, 8]),
        (range(1, 5), [1, 2, 3]),
        (range(1, 8), [2, 4, 6]),
        (range(1, 102), [26, 51, 76]),
        ([7], [7, 7, 7]),
        ([None], [None, None, None]),
        ([1, 2, float("nan"), 3, 4, None], [1, 2, 3]),
    ],
)
def test_quartiles_of_short_lists(spark, values, expected):
    df = numbers(spark, [None if v is None else float(v) for v in values])
    assert stats.exact_quantiles(df, ["v"])["v"] == expected


def brute(values, p):
    ordered = sorted(v for v in values if v is not None and not math.isnan(v))
    return ordered[max(1, math.ceil(p * len(ordered))) - 1]


@pytest.mark.parametrize("kind", ["continuous", "skewed", "few", "third_is_one_value", "two_ends", "sorted"])
def test_exact_quantiles_with_a_coarse_sketch(spark, kind):
    rng = random.Random(kind)
    make = {
        "continuous": lambda i: rng.gauss(0, 1),
        "skewed": lambda i: rng.random() ** 20,
        "few": lambda i: float(rng.randint(0, 3)),
        "third_is_one_value": lambda i: 0.5 if i % 3 == 0 else rng.random(),
        "two_ends": lambda i: float("inf") if i % 2 else -1e300,
        "sorted": lambda i: float(i),
    }[kind]
    values = [make(i) for i in range(4000)]
    df = numbers(spark, values)
    probs = (0.0, 0.01, 0.25, 0.5, 0.75, 1.0)
    # A small sketch and a small remainder force several narrowing rounds.
    found = stats.exact_quantiles(df, ["v"], probs, k=64, finish_rows=20)["v"]
    assert found == [brute(values, p) for p in probs]


def test_exact_quantiles_survive_a_wrong_sketch(spark, monkeypatch):
    values = [float(i) for i in range(500)]
    honest = stats.sketch_quantiles

    def misleading(df, wanted, k=0, **kw):
        return {c: (n, [q[-1]] * len(q)) for c, (n, q) in honest(df, wanted, 64, **kw).items()}

    monkeypatch.setattr(stats, "sketch_quantiles", misleading)
    found = stats.exact_quantiles(numbers(spark, values), ["v"], (0.1, 0.5), finish_rows=100)["v"]
    assert found == [49.0, 249.0]


def test_approximate_quartiles_are_elements(spark):
    df = numbers(spark, [float(i) for i in range(10_000)])
    row = stats.quartiles(df, ["v"], exact=False).first()
    assert abs(row.q1 - 2500) < 60 and abs(row.median - 5000) < 60 and row.q3 == int(row.q3)


def test_quartiles_agree_with_the_built_in(spark, small):
    df = spark.read.parquet(f"{small}/lineitem.parquet")
    columns = ["l_extendedprice", "l_quantity", "l_discount"]
    assert stats.exact_quantiles(df, columns) == dict(zip(columns, df.stat.approxQuantile(columns, [0.25, 0.5, 0.75], 0.0)))


def test_fences(spark):
    df = numbers(spark, [float(i) for i in range(1, 11)])
    row = stats.iqr_bounds(stats.quartiles(df, ["v"])).first()
    assert (row.lower, row.upper) == (-4.5, 15.5) == stats.fences(3.0, 8.0)


TEXTS = ["a", "a", "b", "null", None, None, None, "NA", "NA", "NA"]


def test_mode_ignores_sentinels(spark):
    df = spark.createDataFrame([(t, i) for i, t in enumerate(TEXTS)], "t string, i int")
    rows = {r.column: (r.mode, r.n) for r in stats.modes(df, ["t", "i"]).collect()}
    assert rows == {"t": ("a", 2), "i": ("0", 1)}
    assert stats.modes(df, ["t"], exclude=()).first().mode == "NA"
    counts = [(r.value, r.n) for r in stats.value_counts(df, "t").collect()]
    assert counts == [(None, 3), ("NA", 3), ("a", 2), ("b", 1), ("null", 1)]


def test_imputers(spark):
    rows = [(float(i), "a", 3) for i in range(1, 11)] + [(1000.0, "b", 9), (-1000.0, "NA", -1), (None, None, None)]
    rows += [(float("nan"), "a", 0)]
    df = spark.createDataFrame(rows, "v double, t string, c int")
    v = IqrCapImputer(inputCols=["v"]).fit(df)
    out = [r.v for r in v.transform(df).collect()]
    low, mid, high = (v.getOrDefault(p)[0] for p in ("lower", "median", "upper"))
    q1, median, q3 = stats.exact_quantiles(df, ["v"])["v"]
    assert (low, mid, high) == (q1 - 1.5 * (q3 - q1), median, q3 + 1.5 * (q3 - q1))
    assert out == [*map(float, range(1, 11)), high, low, mid, mid]
    t = ModeImputer(inputCols=["t"]).fit(df).transform(df)
    assert [r.t for r in t.collect()] == ["a"] * 10 + ["b", "a", "a", "a"]
    c = DomainModeImputer(inputCols=["c"], lowest=0, highest=8).fit(df).transform(df)
    assert [r.c for r in c.collect()] == [3] * 13 + [0]
    assert c.schema["c"].dataType.typeName() == "integer"


def test_domain_mode_may_itself_lie_outside(spark):
    df = spark.createDataFrame([(99,), (99,), (1,), (None,)], "c int")
    out = DomainModeImputer(inputCols=["c"]).fit(df).transform(df)
    assert [r.c for r in out.collect()] == [99, 99, 1, 99]


def test_imputers_refuse_empty_columns(spark):
    df = spark.createDataFrame([(None, None)], "v double, t string")
    with pytest.raises(ValueError, match="v"):
        IqrCapImputer(inputCols=["v"]).fit(df)
    with pytest.raises(ValueError, match="t"):
        ModeImputer(inputCols=["t"]).fit(df)


def test_fitted_imputers_are_stored(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "x", 2), (2.0, "NA", 11), (None, "x", 2)], "v double, t string, c int")
    stages = [
        IqrCapImputer(inputCols=["v"]).fit(df),
        ModeImputer(inputCols=["t"]).fit(df),
        DomainModeImputer(inputCols=["c"]).fit(df),
    ]
    model = PipelineModel(stages)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.transform(df).collect() == model.transform(df).collect()
    assert [tuple(r) for r in again.transform(df).collect()] == [(1.0, "x", 2), (2.0, "x", 2), (1.0, "x", 2)]


def test_top_k_and_spread(spark):
    df = numbers(spark, [1.0, 2.0, 3.0, 4.0])
    assert [r.v for r in stats.top_k(df, [F.desc("v")], 2).collect()] == [4.0, 3.0]
    assert stats.sample_stddev(df, "v").first().stddev == pytest.approx(1.2909944487358056)
    assert stats.distinct_values(df.union(df), "v").count() == 4


def test_certificates_are_the_true_rank_errors(spark):
    values = [float(v) for v in range(1, 101)] + [50.0] * 20
    rows = spark.createDataFrame([(v, None if v > 50 else v, None) for v in values] + [(float("nan"), None, None), (None, 7.0, None)], "a double, b double, c double")
    exact = stats.exact_quantiles(rows, ["a", "b", "c"])
    for r in stats.rank_certificate(rows, exact).collect():
        assert r.rank_error == (None if r.column == "c" else 0.0), r
    assert {r.column: r.n for r in stats.rank_certificate(rows, exact).collect()} == {"a": 120, "b": 71, "c": 0}
    off = {r.prob: r for r in stats.rank_certificate(rows, {"a": [25.0, 50.0, 95.5]}).collect()}
    assert (off[0.25].below, off[0.25].upto, off[0.25].rank_error) == (24, 25, 5 / 120)
    assert (off[0.5].below, off[0.5].upto, off[0.5].rank_error) == (49, 70, 0.0)
    assert (off[0.75].below, off[0.75].upto, off[0.75].rank_error) == (115, 115, 26 / 120)


def test_sketched_quartiles_come_with_their_error(spark):
    rows = spark.range(200_000).selectExpr("double(id % 70000) AS v", "double(pow(id, 0.3)) AS w")
    found = stats.certified_quartiles(rows, ["v", "w"], k=256).collect()
    assert len(found) == 6 and all(r.n == 200_000 and r.upto > r.below and r.rank_error <= 2 * stats.sketch_error(256) for r in found)
