import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from petrichor.operators import encode


def indexes(table):
    return {(r.column, r.value): r["index"] for r in table.collect()}


def test_label_orders(spark):
    months = spark.createDataFrame([(m,) for m in (1, 2, 9, 10, 12, 12)], "m int")
    assert indexes(encode.label_table(months, ["m"])) == {
        ("m", "9"): 0.0, ("m", "2"): 1.0, ("m", "12"): 2.0, ("m", "10"): 3.0, ("m", "1"): 4.0,
    }
    days = spark.createDataFrame([("No",)] * 3 + [("Yes",)] * 2, "rain string")
    assert indexes(encode.label_table(days, ["rain"]))["rain", "Yes"] == 0.0
    assert indexes(encode.label_table(days, ["rain"], "frequencyDesc"))["rain", "No"] == 0.0
    assert indexes(encode.label_table(days, ["rain"], "frequencyAsc"))["rain", "Yes"] == 0.0


@pytest.mark.parametrize("order", ["alphabetDesc", "alphabetAsc", "frequencyDesc", "frequencyAsc"])
def test_label_table_equals_the_pipeline_stage(spark, small, order):
    df = spark.read.parquet(f"{small}/part.parquet").select("p_brand", "p_type", F.col("p_size").cast("string").alias("p_size"))
    columns = df.columns
    own = indexes(encode.label_table(df, columns, order))
    many = indexes(encode.label_table(df, columns, order))
    model = encode.string_indexer(columns, order).fit(df)
    built_in = {(c, v): float(i) for c, labels in zip(columns, model.labelsArray) for i, v in enumerate(labels)}
    assert own == many == built_in


def test_invalid_categories(spark):
    seen = spark.createDataFrame([("a",), ("b",)], "c string")
    rows = spark.createDataFrame([("a",), (None,), ("z",)], "c string")
    labels = encode.label_table(seen, ["c"])
    assert [tuple(r) for r in encode.apply_labels(rows, labels, ["c"], "skip").collect()] == [("a", 1.0)]
    kept = {r.c: r.c_num for r in encode.apply_labels(rows, labels, ["c"], "keep").collect()}
    assert kept == {"a": 1.0, None: 2.0, "z": 2.0}
    with pytest.raises(SparkRuntimeException, match="unseen or missing category in c"):
        encode.apply_labels(rows, labels, ["c"]).collect()
    assert encode.string_indexer(["c"], invalid="skip").fit(seen).transform(rows).count() == 1


def test_class_indexed_twice(spark):
    df = spark.createDataFrame([("Yes",), ("No",)], "c string")
    stages = [encode.label_indexer("c", output="one"), encode.label_indexer("one", output="two")]
    rows = {r.c: (r.one, r.two) for r in Pipeline(stages=stages).fit(df).transform(df).collect()}
    assert rows == {"Yes": (0.0, 1.0), "No": (1.0, 0.0)}
    # For two classes, ascending order gives the same in one step.
    once = encode.label_indexer("c", "alphabetAsc").fit(df)
    assert {r.c: r.label for r in once.transform(df).collect()} == {"Yes": 1.0, "No": 0.0}
    names = {r.label: r.original for r in encode.index_to_string(once.transform(df), once).collect()}
    assert names == {1.0: "Yes", 0.0: "No"}


def test_one_hot_leaves_out_the_last_category(spark):
    df = spark.createDataFrame([(c,) for c in "abcde"], "c string")
    stages = [encode.string_indexer(["c"], "alphabetAsc"), encode.one_hot_encoder(["c"]), encode.assembler(["c_hot"])]
    out = Pipeline(stages=stages).fit(df).transform(df).select("c", vector_to_array("features").alias("f"))
    rows = {r.c: r.f for r in out.collect()}
    assert rows["a"] == [1, 0, 0, 0] and rows["e"] == [0, 0, 0, 0]
    assert encode.all_but(out, "c") == ["f"]


def brute_chi_square(pairs):
    rows, cols, n = {}, {}, len(pairs)
    for r, c in pairs:
        rows[r] = rows.get(r, 0) + 1
        cols[c] = cols.get(c, 0) + 1
    total = sum(
        (pairs.count((r, c)) - rows[r] * cols[c] / n) ** 2 / (rows[r] * cols[c] / n) for r in rows for c in cols
    )
    return total, (len(rows) - 1) * (len(cols) - 1)


def test_chi_square_with_empty_cells(spark):
    pairs = [("a", "x")] * 5 + [("a", "y")] * 2 + [("b", "x")] * 4 + [("c", "y")] * 3
    df = spark.createDataFrame(pairs + [(None, "x"), ("a", None)], "f string, t string")
    row = encode.chi_square(df, ["f"], "t").first()
    statistic, freedom = brute_chi_square(pairs)
    assert row.statistic == pytest.approx(statistic) and row.degrees_of_freedom == freedom
    whole = df.na.drop()
    stages = [encode.string_indexer(["f"]), encode.assembler(["f_num"]), encode.label_indexer("t")]
    test = encode.chi_square_test(Pipeline(stages=stages).fit(whole).transform(whole)).first()
    assert test.statistic == pytest.approx(statistic) and test.degreesOfFreedom == freedom and 0 < test.pValue < 1


def test_tokens(spark):
    df = spark.createDataFrame([("The  cat The",), ("",), ("   ",)], "text string")
    assert [r.n_words for r in encode.token_counts(df, "text").collect()] == [4, 1, 0]
    vector = encode.term_frequencies(df, "text", 64).first().features
    assert vector.size == 64 and vector.values.sum() == 4
