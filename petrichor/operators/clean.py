"""Cleaning: pruning, sentinels, empty and unlabelled rows, duplicates, audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from ..functions.columns import MISSING, all_null, any_null, month_of


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Prune columns; names the table lacks are ignored."""
    return df.drop(*columns)


def replace_sentinel(
    df: DataFrame, columns: Sequence[str] | None = None, sentinel: str = MISSING
) -> DataFrame:
    """Turn the sentinel text into NULL.

    Only string columns can hold it: a typed scan has already turned it into
    NULL in the numeric ones, so those in ``columns`` are passed through.
    """
    wanted = set(df.columns if columns is None else columns)
    text = [f.name for f in df.schema if isinstance(f.dataType, StringType) and f.name in wanted]
    return df.na.replace({sentinel: None}, subset=text) if text else df


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def drop_unlabelled(df: DataFrame, label: str) -> DataFrame:
    return df.na.drop("all", subset=[label])


def extract_month(df: DataFrame, date: str, month: str = "Month") -> DataFrame:
    """Replace the date text by its month."""
    return df.withColumn(month, month_of(date)).drop(date)


def dedupe_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    null_keys: str = "collapse",
) -> DataFrame:
    """Keep one row per key: the least by ``order_by``, then by all columns.

    The survivor depends on the data alone. Every task first keeps its own
    least row per key (the group limit Spark derives from ``row_number = 1``),
    so a key that owns a third of the table costs one row per task in the
    shuffle.

    A key with a NULL part is one common group under ``collapse``; ``keep``
    leaves all such rows in place.
    """
    if null_keys == "keep":
        whole = df.filter(~any_null(keys))
        return df.filter(any_null(keys)).unionByName(dedupe_by_key(whole, keys, order_by))
    if null_keys != "collapse":
        raise ValueError(f"null_keys must be collapse or keep, not {null_keys!r}")
    parts = [F.when(~any_null(keys), F.col(k)) for k in keys]
    first = list(order_by or [])
    order = first + [c for c in df.columns if c not in first]
    # Led by a hash, the sort compares one number for most pairs of keys.
    window = Window.partitionBy(F.xxhash64(*parts), *parts).orderBy(*[F.asc_nulls_first(c) for c in order])
    return df.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")


def dedupe_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep an arbitrary row per key; cheaper, but not repeatable."""
    key = F.when(~any_null(keys), F.struct(*keys))
    return df.withColumn("_key", key).dropDuplicates(["_key"]).drop("_key")


def counted_keys(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """The rows that ``dedupe_by_key`` keeps, with ``_copies``: how many rows share the key.

    One aggregate over one scan; each task sends one row and one count per key.
    Whatever is to be said about duplicates, empty and unlabelled rows and the
    rows that stay can be read from this table.
    """
    parts = [F.when(~any_null(keys), F.col(k)).alias(f"_key{i}") for i, k in enumerate(keys)]
    first = list(order_by or [])
    order = first + [c for c in df.columns if c not in first]
    # the least struct is the first row in ascending order, NULL before all else
    least = F.min(F.struct(*[F.col(f"`{c}`") for c in order])).alias("_least")
    found = df.groupBy(*parts).agg(least, F.count("*").alias("_copies"))
    return found.select(*[F.col(f"_least.`{c}`").alias(c) for c in df.columns], "_copies")


def cleaning_audit(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Row counts of every cleaning stage, as one row from one scan.

    ``empty_rows`` and ``unlabelled_rows`` are the loss of their own stage; the
    ``*_cumulative`` columns count the loss since the start.
    """
    return audit_of(counted_keys(df, keys), df.columns, label)


def audit_of(keyed: DataFrame, columns: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    """The audit of a ``counted_keys`` table whose rows consist of ``columns``, one row for each value of ``by``."""
    empty = all_null(columns)
    counts = keyed.groupBy(*by).agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_rows"),
        F.count_if(empty).alias("empty_rows"),
        F.count_if(F.col(label).isNull() & ~empty).alias("unlabelled_rows"),
    )
    duplicates = F.col("total_rows") - F.col("distinct_rows")
    lost = duplicates + F.col("empty_rows") + F.col("unlabelled_rows")
    return counts.select(
        *by,
        "total_rows",
        duplicates.alias("duplicate_rows"),
        "empty_rows",
        (duplicates + F.col("empty_rows")).alias("empty_rows_cumulative"),
        "unlabelled_rows",
        lost.alias("unlabelled_rows_cumulative"),
        (F.col("total_rows") - lost).alias("kept_rows"),
        F.try_divide(lost.cast("double"), F.col("total_rows").cast("double")).alias("unclassified_rate"),
    )
