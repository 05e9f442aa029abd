"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import table
from . import (
    centroid_clustering,
    embedding_dedup,
    language_id,
    line_dedup,
    mixing,
    packing,
    quality_rules,
    simhash_dedup,
    spelling_variants,
    substring_dedup,
    suffix_dedup,
    toxicity,
    url_filter,
)
from .phases import Phases

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _remainder(base: int):
    return F.crc32(F.col("doc_id").cast("string")) % base


@_query
def op1_language_id(spark, folder):
    return language_id.identify(table(spark, folder, "documents"), held_out=_remainder(3) == 1)


@_query
def op2_substring_dedup(spark, folder):
    rows = substring_dedup.remove_repeated_words(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op3_mixing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labelled = mixing.label_domains(table(spark, folder, "labels"))
    rows, domains = mixing.rated(docs, labelled, mixing.SHARES, "good", Phases(spark, "op3"))
    chances = [F.get("__m_p", k).alias(f"p_{d}") for k, d in enumerate(domains)]
    return rows.select("doc_id", F.col("__m_tokens").alias("n_tokens"), *chances, F.col("__m_rate").alias("rate"))


@_query
def op4_embedding_dedup(spark, folder):
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


@_query
def op5_packing(spark, folder):
    pieces = packing.pack(table(spark, folder, "documents"), packing.default_tokenizer())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_query
def op6_simhash_dedup(spark, folder):
    rows = simhash_dedup.near_duplicates(table(spark, folder, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op7_line_dedup(spark, folder):
    rows = line_dedup.without_similar_lines(table(spark, folder, "documents"), short_lines=True)
    return rows.select(
        "doc_id", F.col("__l_lines").alias("n_lines"), F.col("__l_removed").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256")
    )


@_query
def op8_toxicity(spark, folder):
    return toxicity.score_toxicity(
        table(spark, folder, "documents"), table(spark, folder, "labels"), held_out=_remainder(4) == 2
    )


@_query
def op9_quality_rules(spark, folder):
    rows = quality_rules.judged(table(spark, folder, "documents"))
    return rows.select(
        "doc_id",
        F.col("__q_n").alias("n_words"),
        F.col("__q_chars").alias("word_chars"),
        F.col("__q_symbols").alias("n_symbols"),
        F.col("__q_dup_lines").alias("n_dup_lines"),
        F.col("__q_repeat").alias("n_repeat_words"),
        F.col("__q_base_failed").alias("base_failed"),
        F.col("__q_kept").alias("kept"),
    )


@_query
def op10_suffix_dedup(spark, folder):
    rows = suffix_dedup.remove_repeated_bytes(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op11_centroid_clustering(spark, folder):
    rows = centroid_clustering.clustered(table(spark, folder, "embeddings"))
    digest = F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256)
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


@_query
def op12_spelling_variants(spark, folder):
    return spelling_variants.spelling_variants(table(spark, folder, "documents"), every=199)


@_query
def op13_url_filter(spark, folder):
    return url_filter.judged(table(spark, folder, "pages"))
