"""What a Python task holds follows a batch of a few megabytes, and no result follows the batches."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import SparkSession

from petrichor.llm import packing, quality_rules, shingle_dedup
from petrichor.llm.words import text_array
from petrichor.session import BATCH_BYTES, BATCH_SETTING

TOKENIZER = packing.default_tokenizer()


@pytest.fixture
def unset(spark):
    spark.conf.unset(BATCH_SETTING)
    yield spark
    spark.conf.unset(BATCH_SETTING)


def sizes(spark):
    def seen(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    wide = spark.range(0, 6000, 1, 1).selectExpr("repeat('x', 3000) AS text")
    return [r.n for r in wide.mapInArrow(seen, "n long").collect()]


@pytest.mark.parametrize("job", [lambda d: packing.pack(d, TOKENIZER), shingle_dedup.first_of_groups, shingle_dedup.near_copies])
def test_batches_are_small(unset, job):
    assert max(sizes(unset)) > 3 * BATCH_BYTES
    job(unset.createDataFrame([(1, "some words")], "doc_id long, text string")).collect()
    assert max(sizes(unset)) < 1.1 * BATCH_BYTES


def test_a_size_of_the_session_stays(unset):
    unset.conf.set(BATCH_SETTING, "1m")
    packing.pack(unset.createDataFrame([(1, "some words")], "doc_id long, text string"), TOKENIZER).collect()
    assert unset.conf.get(BATCH_SETTING) == "1m" and max(sizes(unset)) < 2 << 20


def test_sequences_do_not_follow_the_batches(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["house", "tree", "river", "cloud", "stone"]) for _ in range(rng.randrange(1, 60)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = []
    for n in (10000, 7):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(n))
        try:
            found.append(sorted(tuple(r) for r in packing.pack(docs, TOKENIZER, size=256, shard_tokens=1024).collect()))
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found[0] == found[1]


def test_shards_are_those_of_one_batch():
    rng = np.random.default_rng(2)
    lens = 2 * np.append(rng.integers(0, 40, 200), [500, 0, 900, 1])
    bounds = np.append(0, np.cumsum(lens))
    ids = text_array(rng.integers(0, 256, bounds[-1]).astype(np.uint8), bounds, binary=True)
    whole = pa.RecordBatch.from_arrays([pa.array(range(len(lens))), ids], ["doc_id", "ids"])
    shards = lambda batches: [(d.to_pylist(), bytes(b), o.tolist()) for d, b, o in packing._shards(iter(batches), 300)]
    want = shards([whole])
    assert [d for s in want for d in s[0]] == list(range(len(lens)))
    for step in (1, 3, 50):
        assert shards([whole.slice(0, 0)] + [whole.slice(i, step) for i in range(0, len(lens), step)]) == want
    assert shards([]) == shards([whole.slice(0, 0)]) == []


def test_the_sample_of_the_rules_starts_no_python_workers(spark, monkeypatch):
    given, usual = [], SparkSession.createDataFrame
    docs = spark.createDataFrame([(1, "many words " * 9), (2, None), (3, "")], "doc_id long, text string")
    monkeypatch.setattr(SparkSession, "createDataFrame", lambda self, data, *a, **b: given.append(data) or usual(self, data, *a, **b))
    quality_rules.judged(docs).collect()
    quality_rules.judged(docs.limit(0)).collect()
    assert [type(d) for d in given] == [pa.Table, pa.Table]
