"""Different texts under one doc_id, some of which share a hash tag."""

import hashlib

import pytest
from pyspark.sql import functions as F

from petrichor.llm import substring_dedup, suffix_dedup
from petrichor.llm.phases import Phases, with_tags


@pytest.fixture(scope="module")
def clashing(spark):
    """Two texts of different lengths whose first tags are equal, with a window that a smaller document has too."""
    shared = " ".join(f"w{i}" for i in range(60))
    text = F.concat(F.repeat(F.lit("x "), (F.col("id") % 7).cast("int") * 40), F.lit(shared + " "), F.col("id").cast("string"))
    found = spark.range(150_000).select(text.alias("text"), (F.col("id") % 7).alias("k"))
    found = found.withColumn("tag", F.xxhash64("text", F.lit(0)).bitwiseAND(F.lit((1 << 31) - 1)))
    pairs = found.groupBy("tag").agg(F.collect_list(F.struct("k", "text")).alias("t")).where("size(t) > 1").collect()
    pair = next(p.t for p in pairs if p.t[0].k != p.t[1].k)
    rows = [(1, shared), (5, pair[0].text), (5, pair[1].text), (5, pair[1].text), (6, pair[0].text), (None, shared), (7, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_a_seed_without_clashes_is_taken(spark, clashing):
    rows = clashing.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    tagged = with_tags(rows, Phases(spark, "t")).collect()
    assert len({(r.doc_id, r.tag) for r in tagged}) == len({(r.doc_id, r.text) for r in tagged})
    assert {r.tag & ((1 << 32) - 1) for r in tagged} == {0}


def brute(units, rows, width):
    """Per row, the units left when windows that start under a smaller id go."""
    first = {}
    for i, u in rows:
        for s in range(len(u) - width + 1):
            key = tuple(u[s : s + width])
            if i is not None:
                first[key] = min(i, first.get(key, i))
    out = []
    for i, u in rows:
        gone = set()
        for s in range(len(u) - width + 1):
            if i is not None and first[tuple(u[s : s + width])] < i:
                gone.update(range(s, s + width))
        out.append((i, len(u), len(gone), [x for k, x in enumerate(u) if k not in gone]))
    return out


def test_words_of_clashing_rows(clashing):
    rows = [(r.doc_id, (r.text or "").split()) for r in clashing.collect()]
    expected = sorted((str(i), n, g, " ".join(k)) for i, n, g, k in brute(None, rows, 50))
    got = substring_dedup.remove_repeated_words(clashing).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == expected


def test_bytes_of_clashing_rows(clashing):
    rows = [(r.doc_id, list((r.text or "").encode())) for r in clashing.collect()]
    expected = sorted((str(i), n, g, hashlib.sha256(bytes(k)).hexdigest()) for i, n, g, k in brute(None, rows, 50))
    got = suffix_dedup.remove_repeated_bytes(clashing).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got) == expected
