"""Distinct values and document frequencies of the packing, by sorting."""

import numpy as np
import pyarrow as pa

from petrichor.llm import packing


def test_distinct_equals_unique():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        values = rng.integers(0, 300, n)
        for found, want in zip(packing.distinct(values), np.unique(values, return_counts=True)):
            assert found.tolist() == want.tolist()


def test_document_frequencies_equal_brute_force():
    rng = np.random.default_rng(2)
    width = np.dtype("<u2")
    docs = [rng.integers(0, 50, rng.integers(1, 40)).astype(width) for _ in range(60)] + [np.array([2], width)]
    batch = pa.RecordBatch.from_arrays([pa.array([d.tobytes() for d in docs], pa.binary())], ["ids"])
    (out,) = packing._frequencies(50, width)(iter([batch]))
    found = dict(zip(*[c.to_pylist() for c in out.columns]))
    want = {t: n for t in range(50) if (n := sum(t in d for d in docs))}
    assert found == want | {-1: sum(map(len, docs)), -2: len(docs)}
