"""Headline queries on one machine; prints one JSON line.

Each query is run to its last row without collecting it. ``one_job_per_column``
times the same steps written as one Spark job per column or count, on the same
session, for comparison.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from petrichor.catalog.observations import DAY_KEYS, observations, scored_rows
from petrichor.catalog.registry import QUERIES, _report, train_observations
from petrichor.operators import stats
from petrichor.plans import learners
from petrichor.session import local_session

HEADLINE = (
    "csv_scan_typed",
    "dedupe_by_key",
    "cleaning_audit",
    "split_by_key",
    "quartiles_exact",
    "quartiles_approx",
    "iqr_cap_impute",
    "mode_per_column",
    "mode_impute",
    "string_index_alpha_desc",
    "string_index_freq",
    "chi_square",
    "tokenize_counts",
    "weighted_f1",
    "confusion_rates",
    "auc_roc",
    "auc_pr_single_feature",
    "roc_curve_exact",
    "roc_curve_binned",
    "lr_train_score",
    "dt_train_score",
)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def quartiles_by_column(spark: SparkSession, folder: str) -> None:
    obs = observations(spark, folder)
    for column in ("price", "quantity", "code", "l_partkey"):
        obs.stat.approxQuantile(column, [0.25, 0.5, 0.75], 0.0)


def modes_by_column(spark: SparkSession, folder: str) -> None:
    obs = observations(spark, folder)
    for column in ("flag", "target", "location", "code", "obs_date"):
        obs.groupBy(column).count().filter(F.col(column).isNotNull()).orderBy(F.desc("count")).take(1)


def audit_by_count(spark: SparkSession, folder: str) -> None:
    obs = observations(spark, folder)
    key = F.concat(F.col(DAY_KEYS[0]), F.lit("-"), F.col(DAY_KEYS[1]))
    unique = obs.withColumn("key", key).dropDuplicates(["key"]).drop("key")
    filled = unique.na.drop("all")
    for stage in (obs, unique, filled, filled.na.drop("all", subset=["target"])):
        stage.count()


def confusion_by_count(spark: SparkSession, folder: str) -> None:
    rows = scored_rows(spark, folder)
    for said in (1.0, 0.0):
        for true in (1.0, 0.0):
            rows.filter((F.col("prediction") == said) & (F.col("label") == true)).count()


COMPARED = {
    "quartiles_exact": quartiles_by_column,
    "mode_per_column": modes_by_column,
    "cleaning_audit": audit_by_count,
    "confusion_rates": confusion_by_count,
}


TRAINED = {
    "lr_train_score": lambda spark, folder: _trained(spark, folder, learners.logistic_regression("selected")),
    "dt_train_score": lambda spark, folder: _trained(spark, folder, learners.decision_tree("bins49")),
    "quartiles_approx": lambda spark, folder: stats.quartiles(observations(spark, folder), ["price", "quantity", "code", "l_partkey"], exact=False),
}


def _trained(spark: SparkSession, folder: str, learner) -> DataFrame:
    return _report("observations", train_observations(spark, folder, learner).predictions)


def timed(fn, repeat: int = 2) -> float:
    best = float("inf")
    for _ in range(repeat):
        start = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores, shuffle_partitions=int(cores) if cores.isdigit() else 8, memory="16g")
    drain(QUERIES["value_counts"](spark, folder))  # warm-up
    heavy = {"lr_train_score", "dt_train_score"}
    steps = QUERIES | TRAINED  # training on the observations, as in every round
    times = {name: timed(lambda: drain(steps[name](spark, folder)), repeat=1 if name in heavy else 2) for name in HEADLINE}
    compared = {name: timed(lambda: fn(spark, folder)) for name, fn in COMPARED.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "one_job_per_column": compared,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
