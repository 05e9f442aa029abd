import random

from pyspark.sql import functions as F

from petrichor.functions.columns import key_fraction, month_of
from petrichor.operators import clean, split
from petrichor.sources.delimited import read_delimited, write_delimited


def test_typed_scan_of_bad_fields(spark, tmp_path):
    (tmp_path / "a.csv").write_text("s,d,i\nNA,NA,20.5\nx,NaN,3\n,,\n")
    rows = read_delimited(spark, str(tmp_path / "a.csv"), "s string, d double, i int").collect()
    assert (rows[0].s, rows[0].d, rows[0].i) == ("NA", None, None)
    assert rows[1].s == "x" and rows[1].d != rows[1].d and rows[1].i == 3
    assert tuple(rows[2]) == (None, None, None)


def test_delimited_roundtrip_keeps_doubles(spark, tmp_path):
    df = spark.createDataFrame([(0.1 + 0.2, "a"), (None, None), (1e-17, "NA")], "d double, s string")
    write_delimited(df, str(tmp_path / "t"), delimiter=";")
    back = read_delimited(spark, str(tmp_path / "t"), df.schema, delimiter=";", null_value="NA")
    assert {tuple(r) for r in back.collect()} == {(0.1 + 0.2, "a"), (None, None), (1e-17, None)}


def test_replace_sentinel_touches_text_only(spark):
    df = spark.createDataFrame([("NA", 1.0, "NA"), ("W", None, "b"), ("null", 2.0, "c")], "a string, n double, key string")
    rows = clean.replace_sentinel(df, ["a", "n"]).collect()
    assert [r.a for r in rows] == [None, "W", "null"]
    assert [r.key for r in rows] == ["NA", "b", "c"]
    assert clean.replace_sentinel(df.select("n"), ["n"]).count() == 3


def test_month(spark):
    df = spark.createDataFrame([("2010-12-01",), ("NA",), (None,), ("2010-x-1",)], "Date string")
    assert [r.m for r in df.select(month_of("Date").alias("m")).collect()] == [12, None, None, None]
    assert clean.extract_month(df, "Date").columns == ["Month"]


def test_empty_and_unlabelled_rows(spark):
    df = spark.createDataFrame([(1, "x"), (None, None), (None, "x"), (2, None), (3, "y"), (4, "z")], "n int, label string")
    assert clean.drop_empty_rows(df).count() == 5
    assert clean.drop_unlabelled(df, "label").count() == 4
    assert clean.drop_columns(df, ["n", "missing"]).columns == ["label"]


KEYED = [(None, "a", 1), (None, "b", 2), ("d", "a", 3), ("d", "a", 4)]


def test_dedupe_collapses_null_keys(spark):
    df = spark.createDataFrame(KEYED, "d string, l string, v int")
    kept = clean.dedupe_by_key(df, ["d", "l"]).collect()
    assert sorted(r.v for r in kept) == [1, 3]
    assert sorted(r.v for r in clean.dedupe_by_key(df, ["d", "l"], null_keys="keep").collect()) == [1, 2, 3]
    assert clean.dedupe_any(df, ["d", "l"]).count() == 2
    assert sorted(r.v for r in clean.dedupe_by_key(df.withColumn("neg", -F.col("v")), ["d", "l"], ["neg"]).collect()) == [2, 4]


def test_dedupe_is_independent_of_partitioning(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), (F.col("id") * 37 % 1000).alias("v"), "id"
    )
    results = [
        sorted(map(tuple, clean.dedupe_by_key(df.repartition(n), ["k"]).collect())) for n in (1, 8)
    ]
    assert results[0] == results[1]
    assert len(results[0]) == 50


def test_dedupe_limits_every_task_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = clean.dedupe_by_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_audit_counts(spark):
    rows = [("d1", "a", 1, "Y"), ("d1", "a", 2, "N"), ("d2", "a", 1, None), ("d3", "a", None, "Y"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "d string, l string, v int, label string")
    audit = clean.cleaning_audit(df, ["d", "l"], "label").first().asDict()
    assert audit == {
        "total_rows": 5,
        "duplicate_rows": 1,
        "empty_rows": 1,
        "empty_rows_cumulative": 2,
        "unlabelled_rows": 1,
        "unlabelled_rows_cumulative": 3,
        "kept_rows": 2,
        "unclassified_rate": 0.6,
    }


def test_audit_of_an_empty_table(spark):
    df = spark.createDataFrame([], "d string, label string")
    audit = clean.cleaning_audit(df, ["d"], "label").first()
    assert audit.total_rows == 0 and audit.kept_rows == 0 and audit.unclassified_rate is None


def test_split_by_key_is_complete_disjoint_and_stable(spark):
    df = spark.range(5000).select((F.col("id") % 1000).alias("k"), "id")
    sides = split.split_by_key(df, ["k"], (0.7, 0.3), seed=3)
    again = split.split_by_key(df.repartition(7), ["k"], (0.7, 0.3), seed=3)
    ids = [{r.id for r in s.collect()} for s in sides]
    assert ids == [{r.id for r in s.collect()} for s in again]
    assert not ids[0] & ids[1] and len(ids[0] | ids[1]) == 5000
    keys = [{i % 1000 for i in part} for part in ids]
    assert not keys[0] & keys[1]
    assert 0.65 < len(ids[0]) / 5000 < 0.75
    thirds = split.split_by_key(df, ["k"], (1, 1, 1))
    assert sum(t.count() for t in thirds) == 5000


def test_split_random_and_folds(spark):
    df = spark.range(2000)
    a, b = split.split_random(df, [0.66, 0.34], 0)
    assert a.count() + b.count() == 2000
    folds = {r.fold: r["count"] for r in split.with_fold(df, ["id"], 5).groupBy("fold").count().collect()}
    assert sorted(folds) == [0, 1, 2, 3, 4] and min(folds.values()) > 300
    place = df.select(key_fraction(["id"], 1).alias("f")).agg(F.min("f"), F.max("f")).first()
    assert 0 <= place[0] and place[1] < 1


def test_counted_keys_are_the_kept_rows_with_their_copies(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]), rng.choice([None, float("nan"), -0.5, 3.0]), rng.choice(["Yes", None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, `l` int, v double, target string").repartition(5)
    counted = clean.counted_keys(df, ["k", "l"])
    pick = lambda d: sorted(map(repr, d.select("k", "l", "v", "target").collect()))
    assert pick(counted) == pick(clean.dedupe_by_key(df, ["k", "l"]))
    copies = {(r.k, r.l) if r.k is not None and r.l is not None else None: r["_copies"] for r in counted.collect()}
    expected = {}
    for k, l, *_ in rows:
        key = (k, l) if k is not None and l is not None else None
        expected[key] = expected.get(key, 0) + 1
    assert copies == expected
    audit = clean.cleaning_audit(df, ["k", "l"], "target").first()
    kept = clean.drop_unlabelled(clean.drop_empty_rows(clean.dedupe_by_key(df, ["k", "l"])), "target")
    assert (audit.total_rows, audit.duplicate_rows, audit.kept_rows) == (300, 300 - len(expected), kept.count())


def test_audit_scans_once(spark):
    rows = spark.range(5).selectExpr("id AS k", "id AS v", "'Yes' AS target")
    plan = clean.cleaning_audit(rows, ["k"], "target")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1
    none = clean.cleaning_audit(rows.where("k > 9"), ["k"], "target").first()
    assert (none.total_rows, none.kept_rows, none.unclassified_rate) == (0, 0, None)
