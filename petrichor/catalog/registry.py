"""One query per operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import class_probability, sentinel_to_null
from ..operators import clean, correlate, curves, encode, evaluate, impute, profile, split, stats
from ..plans import learners, search, workflow
from ..plans.presets import FeatureSet
from ..session import landed, shared_dir
from ..sources.delimited import first_row, read_delimited, write_delimited
from ..sources.sinks import load_curve, load_model, save_curve, save_model
from ..sources.tables import table
from .observations import DAY_KEYS, KEYS, OBS_FEATURES, OBS_SCHEMA, observations, scored_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ROW = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Scans and cleaning ---------------------------------------------------------


@_query
def csv_scan_typed(spark, folder):
    path = shared_dir(spark, "csv")
    write_delimited(observations(spark, folder), path)
    return read_delimited(spark, path, OBS_SCHEMA)


@_query
def drop_columns(spark, folder):
    return clean.drop_columns(observations(spark, folder), ["quantity", "code", "not_there"])


@_query
def replace_sentinel(spark, folder):
    return clean.replace_sentinel(observations(spark, folder), ["flag", "target", "price", "code"])


@_query
def drop_empty_rows(spark, folder):
    return clean.drop_empty_rows(observations(spark, folder).select("price", "quantity", "target"))


@_query
def drop_unlabelled(spark, folder):
    return clean.drop_unlabelled(observations(spark, folder), "target")


@_query
def dedupe_by_key(spark, folder):
    return clean.dedupe_by_key(observations(spark, folder), DAY_KEYS)


@_query
def dedupe_null_keys(spark, folder):
    return clean.dedupe_by_key(observations(spark, folder), ["obs_date", "flag"])


@_query
def dedupe_keep_null_keys(spark, folder):
    return clean.dedupe_by_key(observations(spark, folder), ["obs_date", "flag"], null_keys="keep")


@_query
def cleaning_audit(spark, folder):
    audit = clean.cleaning_audit(observations(spark, folder), DAY_KEYS, "target")
    return audit.withColumn("unclassified_rate", F.round("unclassified_rate", 9))


@_query
def train_audits(spark, folder):
    """The audit of each side of a split by keys with NULL parts, and how many rows the side has left."""
    features = replace(OBS_FEATURES, keys=("obs_date", "flag"))
    keyed = workflow.keyed_sides(observations(spark, folder), features)
    audits = workflow.audits_of_sides(keyed, features).withColumn("unclassified_rate", F.round("unclassified_rate", 9))
    sides = workflow.rows_of_sides(keyed, features, 2)
    left = [side.agg(F.lit(i).alias("_side"), F.count("*").alias("rows_left")) for i, side in enumerate(sides)]
    return audits.join(left[0].union(left[1]), "_side").withColumnRenamed("_side", "side")


@_query
def extract_month(spark, folder):
    return clean.extract_month(observations(spark, folder), "obs_date")


@_query
def first_observation(spark, folder):
    return first_row(observations(spark, folder), "obs_date", "location", *ROW)


@_query
def split_by_key(spark, folder):
    train, test = split.split_by_key(observations(spark, folder), KEYS)
    return train.select(*ROW, F.lit("train").alias("side")).unionByName(
        test.select(*ROW, F.lit("test").alias("side"))
    )


@_query
def fold_counts(spark, folder):
    train, _ = split.split_by_key(observations(spark, folder), KEYS)
    return split.with_fold(train, KEYS, 5).groupBy("fold").agg(F.count("*").alias("n"))


@_query
def nested_split_counts(spark, folder):
    """Sides of a split of a split."""
    train, _ = split.split_by_key(observations(spark, folder), KEYS)
    inner = split.split_by_key(train, KEYS, level=1)
    sides = [side.select(F.lit(i).alias("side")) for i, side in enumerate(inner)]
    return sides[0].union(sides[1]).groupBy("side").agg(F.count("*").alias("n"))


@_query
def split_random(spark, folder):
    """Every row once, with whether both sides hold about their share. Which
    side a row falls on is Spark's to draw."""
    train, test = split.split_random(observations(spark, folder), [0.7, 0.3], seed=0)
    both = train.withColumn("in_train", F.lit(1)).unionByName(test.withColumn("in_train", F.lit(0)))
    share = both.agg(F.avg("in_train").between(0.67, 0.73).alias("share_is_right"))
    return both.drop("in_train").crossJoin(F.broadcast(share))


@_query
def clean_and_split(spark, folder):
    """The training and test rows a training run starts from."""
    train, test = workflow.clean_sides(observations(spark, folder), OBS_FEATURES)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@_query
def prepare_features(spark, folder):
    """Test rows as vectors, with the values and codes of the training rows."""
    train, test = workflow.clean_sides(observations(spark, folder), OBS_FEATURES)
    prepared = workflow.preparation(OBS_FEATURES, labelled=True).fit(train).transform(test)
    vector = vector_to_array(F.col("features"))
    width = len(OBS_FEATURES.vector_inputs)
    return prepared.select(*ROW, "code", "label", *[F.get(vector, F.lit(i)).alias(f"f{i}") for i in range(width)])


# Statistics and imputation --------------------------------------------------


@_query
def value_counts(spark, folder):
    return stats.value_counts(observations(spark, folder), "flag")


@_query
def mode_per_column(spark, folder):
    return stats.modes(observations(spark, folder), ["flag", "target", "location", "code", "obs_date"])


@_query
def quartiles_exact(spark, folder):
    return stats.quartiles(observations(spark, folder), ["price", "quantity", "code", "l_partkey"])


@_query
def quartiles_narrowed(spark, folder):
    """A coarse sketch and few rows to finish with, so that the interval is narrowed again and again."""
    columns = ["price", "quantity", "code", "l_partkey"]
    found = stats.exact_quantiles(observations(spark, folder), columns, k=64, finish_rows=20)
    names = ("q1", "median", "q3")
    rows = [F.struct(F.lit(c).alias("column"), *[F.lit(v).cast("double").alias(n) for n, v in zip(names, found[c])]) for c in columns]
    return spark.range(1).select(F.inline(F.array(*rows)))


@_query
def quartiles_approx(spark, folder):
    """Sketched quartiles by their certificates: real values of the column, within twice the stated error of the rank."""
    found = stats.certified_quartiles(observations(spark, folder), ["price", "quantity", "code", "l_partkey"])
    within = (F.col("rank_error") <= 2 * stats.sketch_error()).alias("within_error")
    return found.select("column", "prob", "n", (F.col("upto") > F.col("below")).alias("occurs"), within)


def _with_nan(spark, folder):
    """Observations whose price is NaN in some rows, and missing in others."""
    price = F.when(F.col("l_suppkey") % 29 == 0, F.lit(float("nan"))).otherwise(F.col("price"))
    return observations(spark, folder).withColumn("price", price)


@_query
def correlation_matrix(spark, folder):
    found = correlate.correlation_matrix(_with_nan(spark, folder), ["price", "quantity", "code", "l_partkey", "l_linenumber"])
    return found.select("left", "right", "n", F.round("correlation", 9).alias("correlation"))


@_query
def null_rate_profile(spark, folder):
    """Exact rates; whether the distinct estimate is within three standard errors of the exact count."""
    rows = _with_nan(spark, folder)
    found = profile.rates(profile.profile(rows))
    exact = stats.value_frequencies(rows, rows.columns).where("value is not null and value not in ('NaN', 'NA')")
    exact = exact.groupBy("column").agg(F.count("*").alias("n_distinct"))
    off = F.abs(F.col("distinct_estimate") - F.col("n_distinct"))
    rates = [F.round(c, 9).alias(c) for c in ("null_rate", "nan_rate", "sentinel_rate")]
    within = (off <= 3 * profile.distinct_error() * F.col("n_distinct")).alias("distinct_within_error")
    return found.join(exact, "column").select("column", "rows", *rates, "n_distinct", within)


@_query
def iqr_bounds(spark, folder):
    return stats.iqr_bounds(stats.quartiles(observations(spark, folder), ["price", "quantity", "code"]))


@_query
def iqr_cap_impute(spark, folder):
    obs = observations(spark, folder).select(*ROW, "price", "quantity", F.col("code").cast("double").alias("code"))
    return impute.IqrCapImputer(inputCols=["price", "quantity", "code"]).fit(obs).transform(obs)


@_query
def mode_impute(spark, folder):
    obs = observations(spark, folder).select(*ROW, "flag", "target")
    return impute.ModeImputer(inputCols=["flag", "target"]).fit(obs).transform(obs)


@_query
def mode_domain_impute(spark, folder):
    obs = observations(spark, folder).select(*ROW, "code")
    return impute.DomainModeImputer(inputCols=["code"], lowest=0, highest=8).fit(obs).transform(obs)


@_query
def distinct_labels(spark, folder):
    return stats.distinct_values(observations(spark, folder), "target")


@_query
def prediction_stddev(spark, folder):
    return stats.sample_stddev(scored_rows(spark, folder), "prediction").select(F.round("stddev", 9).alias("stddev"))


@_query
def topk_scores(spark, folder):
    rows = scored_rows(spark, folder).select(*KEYS, "score", "price", "label")
    order = [F.desc("score"), F.desc("price"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    return stats.top_k(rows, order, 17)


# Encoding -------------------------------------------------------------------


def _with_month(spark, folder):
    obs = observations(spark, folder)
    return obs.select(*ROW, "obs_date", "location", "price", "quantity", "target", sentinel_to_null("flag").alias("flag"))


@_query
def string_index_alpha_desc(spark, folder):
    obs = clean.extract_month(_with_month(spark, folder), "obs_date").select(*ROW, "Month", "location")
    labels = encode.label_table(obs, ["Month", "location"], "alphabetDesc")
    return encode.apply_labels(obs, labels, ["Month", "location"])


@_query
def string_index_freq(spark, folder):
    return encode.label_table(_with_month(spark, folder), ["flag", "location", "target"], "frequencyDesc")


@_query
def label_index(spark, folder):
    """The class indexed once and, through its index, a second time."""
    rows = clean.drop_unlabelled(observations(spark, folder), "target").select(*ROW, "target")
    first = encode.label_indexer("target", output="once")
    second = encode.label_indexer("once", output="twice")
    return Pipeline(stages=[first, second]).fit(rows).transform(rows).select(*ROW, "target", "once", "twice")


@_query
def index_skip_invalid(spark, folder):
    rows = _with_month(spark, folder).select(*ROW, "flag")
    labels = encode.label_table(rows, ["flag"])
    return encode.apply_labels(rows, labels, ["flag"], invalid="skip")


@_query
def index_keep_invalid(spark, folder):
    rows = _with_month(spark, folder).select(*ROW, "flag")
    labels = encode.label_table(rows, ["flag"])
    return encode.apply_labels(rows, labels, ["flag"], invalid="keep")


@_query
def one_hot_cells(spark, folder):
    """Vector length and the place of the one (-1: the last category)."""
    rows = _with_month(spark, folder).select(*ROW, "flag", "location")
    columns = ["flag", "location"]
    stages = [encode.string_indexer(columns, invalid="skip"), encode.one_hot_encoder(columns)]
    hot = Pipeline(stages=stages).fit(rows).transform(rows)
    cells = []
    for c in columns:
        indicator = vector_to_array(F.col(c + encode.HOT))
        cells += [
            F.size(indicator).alias(f"{c}_length"),
            (F.array_position(indicator, F.lit(1.0)) - 1).cast("int").alias(f"{c}_place"),
        ]
    return hot.select(*ROW, *cells)


@_query
def assemble_features(spark, folder):
    rows = clean.extract_month(_with_month(spark, folder), "obs_date")
    rows = rows.na.drop(subset=["price", "quantity", "flag"])
    indexed = encode.string_indexer(["Month", "location", "flag"]).fit(rows).transform(rows)
    inputs = ["price", "quantity", "Month_num", "location_num", "flag_num"]
    assembled = encode.assembler(inputs).transform(indexed)
    vector = vector_to_array(F.col("features"))
    return assembled.select(*ROW, *[F.get(vector, F.lit(i)).alias(f"f{i}") for i in range(len(inputs))])


@_query
def all_but_label(spark, folder):
    """A vector of every column but the keys and the class."""
    rows = table(spark, folder, "lineitem").select(*KEYS, "l_tax", "l_discount", "l_quantity", "l_linestatus")
    inputs = encode.all_but(rows, *KEYS, "l_linestatus")
    vector = vector_to_array(F.col("features"))
    return encode.assembler(inputs).transform(rows).select(*KEYS, *[F.get(vector, F.lit(i)).alias(f"f{i}") for i in range(len(inputs))])


@_query
def index_to_string(spark, folder):
    rows = clean.drop_unlabelled(observations(spark, folder), "target").select("target")
    indexer = encode.label_indexer("target").fit(rows)
    labels = stats.distinct_values(indexer.transform(rows), "label")
    return encode.index_to_string(labels, indexer)


@_query
def chi_square(spark, folder):
    obs = observations(spark, folder).withColumn("flag", sentinel_to_null("flag"))
    found = encode.chi_square(obs, ["flag", "code", "location"], "target")
    return found.withColumn("statistic", F.round("statistic", 6))


@_query
def chi_square_p_values(spark, folder):
    """Features of an even number of degrees of freedom, whose tail SQL can add up."""
    obs = observations(spark, folder).withColumn("flag", sentinel_to_null("flag"))
    found = encode.chi_square_p_values(obs, ["flag", "location"], "target")
    return found.select("feature", "degrees_of_freedom", F.round("statistic", 6).alias("statistic"), F.round("p_value", 9).alias("p_value"))


@_query
def tokenize_counts(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return encode.token_counts(documents, "text").select("doc_id", "n_words")


@_query
def hashing_tf(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    counts = vector_to_array(F.col("features"))
    return encode.term_frequencies(documents, "text", buckets=1024).select(
        "doc_id", F.aggregate(counts, F.lit(0.0), lambda a, x: a + x).cast("long").alias("n_terms")
    )


# Evaluation -----------------------------------------------------------------


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


@_query
def accuracy_error(spark, folder):
    return _rounded(evaluate.accuracy_error(scored_rows(spark, folder)), "accuracy", "error")


@_query
def error_rate(spark, folder):
    return _rounded(evaluate.error_rate(scored_rows(spark, folder)), "error_rate")


@_query
def weighted_f1(spark, folder):
    found = evaluate.weighted_metrics(scored_rows(spark, folder))
    return _rounded(found, *found.columns)


@_query
def tpr_by_label(spark, folder):
    found = evaluate.class_metrics(scored_rows(spark, folder))
    return _rounded(found.select("label", "support", "tp", "true_positive_rate"), "true_positive_rate")


@_query
def fpr_by_label(spark, folder):
    found = evaluate.class_metrics(scored_rows(spark, folder))
    return _rounded(found.select("label", "predicted", "tp", "false_positive_rate"), "false_positive_rate")


@_query
def confusion_matrix(spark, folder):
    return evaluate.confusion_matrix(scored_rows(spark, folder))


@_query
def confusion_rates(spark, folder):
    rates = ("accuracy", "recall", "false_positive_rate", "precision")
    return _rounded(evaluate.confusion_rates(scored_rows(spark, folder)), *rates)


@_query
def error_confidence(spark, folder):
    found = evaluate.error_confidence(scored_rows(spark, folder))
    return _rounded(found, *[c for c in found.columns if c != "n"])


@_query
def auc_hard_labels(spark, folder):
    points = curves.curve(scored_rows(spark, folder), "prediction", num_bins=1000)
    return _rounded(curves.areas(points).select("auc_roc"), "auc_roc")


@_query
def auc_roc(spark, folder):
    points = curves.curve(scored_rows(spark, folder), "price", num_bins=1000)
    return _rounded(curves.areas(points).select("auc_roc"), "auc_roc")


@_query
def auc_pr(spark, folder):
    points = curves.curve(scored_rows(spark, folder), "score", num_bins=15)
    return _rounded(curves.areas(points).select("auc_pr"), "auc_pr")


@_query
def auc_pr_single_feature(spark, folder):
    """How well one raw feature ranks the classes: no bins."""
    rows = observations(spark, folder).select("price", (F.col("target") == "O").cast("double").alias("label"))
    return _rounded(curves.areas(curves.curve(rows, "price")).select("auc_pr"), "auc_pr")


@_query
def roc_curve_exact(spark, folder):
    return _rounded(curves.roc_curve(curves.curve(scored_rows(spark, folder), "price")), "x", "y")


@_query
def roc_curve_binned(spark, folder):
    return _rounded(curves.roc_curve(curves.curve(scored_rows(spark, folder), "price", num_bins=15)), "x", "y")


@_query
def pr_curve(spark, folder):
    return _rounded(curves.pr_curve(curves.curve(scored_rows(spark, folder), "score", num_bins=15)), "x", "y")


@_query
def roc_sink_roundtrip(spark, folder):
    points = curves.roc_curve(curves.curve(scored_rows(spark, folder), "score", num_bins=15))
    path = shared_dir(spark, "roc")
    save_curve(points, path)
    return _rounded(load_curve(spark, path), "x", "y")


# Learners -------------------------------------------------------------------
#
# Classes are planted, so that the right answer has a closed form. Training on
# the observations with the published settings is in the tests and the benchmark.


def _report(name: str, predictions: DataFrame) -> DataFrame:
    pairs = landed(learners.scored(predictions), "scores")
    points = curves.curve(pairs, "score", num_bins=1000)
    rates = evaluate.confusion_rates(pairs).select(F.lit(name).alias("learner"), "tp", "fp", "tn", "fn", "accuracy")
    both = rates.unionByName(_rounded(curves.areas(points), "auc_roc", "auc_pr"), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def train_observations(spark, folder, learner):
    return workflow.train(observations(spark, folder), OBS_FEATURES, learner)


#: Numbers of few values and a class that the first two decide together.
PLANTED = FeatureSet(name="planted", keys=KEYS, label="target", numeric=("discount", "tax"))
#: One yes-or-no number, which is the class, or has a hand in it.
BINARY = FeatureSet(name="binary", keys=KEYS, label="target", numeric=("large",))
#: Categories as indicator vectors; the class is whether one of them has a certain value.
HOT = FeatureSet(
    name="hot", keys=KEYS, label="target", numeric=("discount",), numeric_in_vector=False, categorical=("flag", "place"), one_hot=True, invalid="keep"
)


def planted(spark, folder):
    """Rows of class O where both numbers are large: one cut of a tree can't tell, two can.
    The class is missing in some rows, which training leaves out."""
    large = (F.col("l_discount") > 0.045) & (F.col("l_tax") > 0.035)
    target = F.when(F.col("l_suppkey") % 23 != 0, F.when(large, "O").otherwise("F"))
    numbers = [F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax")]
    return table(spark, folder, "lineitem").select(*KEYS, *numbers, target.alias("target"))


def binary(spark, folder, target):
    large = (F.col("l_discount") > 0.045).cast("double").alias("large")
    return table(spark, folder, "lineitem").select(*KEYS, large, target.alias("target"))


@_query
def dt_train_score(spark, folder):
    learner = learners.decision_tree("bins49")
    return _report("decision tree", workflow.train(planted(spark, folder), PLANTED, learner).predictions)


@_query
def lr_train_score(spark, folder):
    rows = binary(spark, folder, F.when(F.col("l_discount") > 0.045, "O").otherwise("F"))
    return _report("logistic regression", workflow.train(rows, BINARY, learners.logistic_regression("selected")).predictions)


@_query
def rf_train_score(spark, folder):
    learner = learners.random_forest("deep")
    return _report("random forest", workflow.train(planted(spark, folder), PLANTED, learner).predictions)


@_query
def one_hot_train_score(spark, folder):
    """A tree on indicator vectors of table-backed codes."""
    li = table(spark, folder, "lineitem")
    place = F.concat(F.lit("S"), (F.col("l_suppkey") % 49).cast("string"))
    target = F.when((F.col("l_returnflag") == "R") | (place == "S7"), "O").otherwise("F")
    rows = li.select(*KEYS, F.col("l_discount").alias("discount"), F.col("l_returnflag").alias("flag"), place.alias("place"), target.alias("target"))
    return _report("one-hot tree", workflow.train(rows, HOT, learners.decision_tree("entropy_9_2")).predictions)


@_query
def pipeline_rf(spark, folder):
    """Assembler, class indexer and forest as one pipeline on plain numbers."""
    train, test = split.split_by_key(planted(spark, folder).dropna(), KEYS)
    stages = [encode.assembler(PLANTED.numeric), encode.label_indexer("target", "frequencyDesc"), learners.random_forest("shallow")]
    return _report("pipeline forest", Pipeline(stages=stages).fit(train).transform(test))


@_query
def cv_metrics(spark, folder):
    rows = split.with_fold(planted(spark, folder).dropna(), KEYS, 5)
    learner = learners.random_forest("shallow")
    stages = [encode.assembler(PLANTED.numeric), encode.label_indexer("target", "frequencyDesc"), learner]
    grid = learners.parameter_grid(learner, learners.GRIDS["forest_small"])
    model = learners.cross_validate(rows, Pipeline(stages=stages), grid, folds=5, fold_column="fold")
    return _rounded(learners.cv_results(spark, model), "avg_metric", "std_metric")


@_query
def search_best_model(spark, folder):
    """The best of three depths, its average area, the fits it took, and its cells over all rows."""
    rows = planted(spark, folder).dropna()
    learner = learners.decision_tree("bins49")
    found = search.search(rows, PLANTED, learner, {"maxDepth": [1, 2, 3], "impurity": ["gini"]}, cleaned=True)
    best = found.results.filter("rank = 1").select("params", F.round("avg_metric", 9).alias("avg_metric"))
    cells = evaluate.confusion_matrix(found.model.transform(rows)).select("tp", "fp", "tn", "fn")
    fits = [F.lit(n).alias(f"{what}_fitted") for what, n in found.fits.items()]
    both = best.unionByName(cells, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select("*", *fits)


@_query
def threshold_cells(spark, folder):
    """Cells of one score at many thresholds, for odd and even lines apart."""
    rows = scored_rows(spark, folder).withColumn("half", F.col("l_linenumber") % 2)
    running = curves.running_counts(rows, "score", by=["half"])
    return curves.threshold_cells(running, [0.0, 0.25, 0.5, 0.75, 1.0, 1.25, 1e6], by=["half"])


@_query
def areas_by_group(spark, folder):
    """Both areas of one score for each line number, from one set of curves."""
    points = curves.curve(scored_rows(spark, folder), "score", by=["l_linenumber"])
    return _rounded(curves.areas(points, by=["l_linenumber"]), "auc_roc", "auc_pr")


@_query
def lr_coefficients(spark, folder):
    """Without a penalty, one yes-or-no input has the logarithm of the odds ratio for its coefficient."""
    learner = learners.logistic_regression("medium", regParam=0.0, maxIter=200, tol=1e-12)
    trained = workflow.train(binary(spark, folder, F.col("l_linestatus")), BINARY, learner)
    return learners.coefficients(spark, trained.model, BINARY.vector_inputs).withColumn("coefficient", F.round("coefficient", 5))


@_query
def score_unlabelled(spark, folder):
    """Every key scored, by class and prediction, rows without a class among them."""
    model = workflow.train(planted(spark, folder), PLANTED, learners.decision_tree("bins49")).model
    later = workflow.score(planted(spark, folder), PLANTED, model)
    return later.groupBy("label", "prediction").agg(F.count("*").alias("n"), F.sum(class_probability()).alias("score"))


@_query
def model_roundtrip(spark, folder):
    """Per class and prediction: the rows and the score sum of the fitted and
    of the stored and reloaded pipeline."""
    trained = workflow.train(planted(spark, folder), PLANTED, learners.decision_tree("bins49"))
    path = shared_dir(spark, "model")
    save_model(trained.model, path)
    fitted = learners.scored(trained.predictions).withColumn("pipeline", F.lit("fitted"))
    loaded = learners.scored(load_model(path).transform(trained.test)).withColumn("pipeline", F.lit("loaded"))
    return (
        fitted.unionByName(loaded)
        .groupBy("pipeline", "label", "prediction")
        .agg(F.count("*").alias("n"), F.round(F.sum("score"), 6).alias("score"))
    )
