"""Correlations and column profiles."""

import math
import random

import pytest

from petrichor.operators import correlate, profile

NAN = float("nan")


def brute(rows, i, j):
    pairs = [(r[i], r[j]) for r in rows if all(v is not None and not math.isnan(v) for v in (r[i], r[j]))]
    if len(pairs) < 2 or any(math.isinf(v) for p in pairs for v in p):
        return len(pairs), None, None
    x, y = zip(*pairs)
    mx, my = math.fsum(x) / len(x), math.fsum(y) / len(y)
    co = math.fsum((a - mx) * (b - my) for a, b in pairs)
    dx, dy = math.fsum((a - mx) ** 2 for a in x), math.fsum((b - my) ** 2 for b in y)
    return len(pairs), co / (len(pairs) - 1), co / math.sqrt(dx * dy) if dx and dy else None


@pytest.mark.parametrize("parts,block", [(1, 64), (7, 2), (90, 3)])
def test_correlations_equal_brute_force(spark, parts, block):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        a = rng.gauss(1e8, 1)
        row = [a, -2 * a + rng.gauss(0, 1), rng.gauss(0, 1), 7.0, float(i % 5)]
        rows.append(tuple(None if rng.random() < 0.1 else NAN if rng.random() < 0.1 else v for v in row) + (math.inf if i == 9 else 1.0 * i,))
    names = ["a", "b", "c", "same", "few", "end.less"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(parts)
    got = {(r.left, r.right): r for r in correlate.correlation_matrix(df, block=block).collect()}
    assert len(got) == 15
    for i, a in enumerate(names):
        for j in range(i + 1, len(names)):
            n, covariance, correlation = brute(rows, i, j)
            row = got[a, names[j]]
            assert row.n == n
            assert row.covariance == (None if covariance is None else pytest.approx(covariance, rel=1e-6, abs=1e-6))
            assert row.correlation == (None if correlation is None else pytest.approx(correlation, rel=1e-6, abs=1e-6))
    matrix = correlate.correlation_matrix(df)
    assert correlate.redundant_columns(matrix, names, 0.8) == ["b"]
    assert correlate.redundant_columns(matrix, names[::-1], 0.8) == ["a"]


def test_correlations_of_odd_tables(spark):
    rows = spark.createDataFrame([(1, 2.0, "x"), (2, None, "y")], "a int, b double, t string")
    assert [tuple(r) for r in correlate.correlation_matrix(rows).collect()] == [("a", "b", 1, None, None)]
    assert [r.n for r in correlate.correlation_matrix(rows.where("a > 5")).collect()] == [0]
    assert not correlate.correlation_matrix(rows, ["a"]).collect()
    for wrong in (["a", "a"], ["a", "t"], ["a", "none"]):
        with pytest.raises(ValueError):
            correlate.correlation_matrix(rows, wrong)


def test_500_columns(spark):
    wide = spark.range(300).selectExpr(*[f"double((id * {i + 1}) % 97) AS c{i}" for i in range(500)])
    found = correlate.correlation_matrix(wide)
    assert found.count() == 500 * 499 // 2
    rows = [tuple(r) for r in wide.collect()]
    names = {(f"c{i}", f"c{j}"): (i, j) for i, j in ((0, 1), (63, 64), (10, 499))}
    for r in found.where(" or ".join(f"(left = '{a}' and right = '{b}')" for a, b in names)).collect():
        assert r.correlation == pytest.approx(brute(rows, *names[r.left, r.right])[2], abs=1e-9)
    made = profile.rates(profile.profile(wide)).collect()
    assert len(made) == 500 and {r.distinct_estimate for r in made} <= {1, *range(94, 101)} and {r.rows for r in made} == {300}


def test_profile_counts_each_kind_of_missing(spark):
    rows = [(1, 0.0, "NA", None), (None, -0.0, "a", None), (3, NAN, None, None), (3, None, "null", None)]
    df = spark.createDataFrame(rows, "i int, `d.x` double, t string, v double")
    got = {r.column: r for r in profile.rates(profile.profile(df)).collect()}
    counts = {c: (r.rows, r.nulls, r.nans, r.sentinels, r.missing_rate, r.distinct_estimate) for c, r in got.items()}
    assert counts == {"i": (4, 1, 0, 0, 0.25, 2), "d.x": (4, 1, 1, 0, 0.5, 1), "t": (4, 1, 0, 1, 0.5, 2), "v": (4, 4, 0, 0, 1.0, 0)}
    assert profile.sparse_columns(profile.profile(df), 0.5) == ["d.x", "t", "v"]
    assert [(r.rows, r.null_rate, r.distinct_estimate) for r in profile.rates(profile.profile(df.where("i > 9"), ["i"])).collect()] == [(0, None, 0)]


def test_profiles_of_parts_make_the_whole(spark):
    df = spark.range(60_000).selectExpr("id", "id % 7 AS few", "if(id % 3 = 0, null, id % 20000) AS some")
    parts = [profile.profile(df.where(f"id % 3 = {k}")) for k in range(3)]
    whole = {r.column: r for r in profile.rates(profile.merged(*parts)).collect()}
    assert [whole[c].rows for c in ("id", "few", "some")] == [60_000] * 3 and whole["some"].nulls == 20_000
    error = 3 * profile.distinct_error()
    for c, n in (("id", 60_000), ("few", 7), ("some", df.select("some").distinct().count() - 1)):
        assert abs(whole[c].distinct_estimate - n) <= error * n
