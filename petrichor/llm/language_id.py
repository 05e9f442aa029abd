"""Language identification with averaged hashed subword embeddings and a linear softmax.

A text's subwords are its byte n-grams of two and four bytes after lower-casing A-Z,
hashed into buckets. Each bucket has an embedding; a text is the average of its
subwords' embeddings, and a linear softmax on that average gives the languages.
Embeddings and softmax are trained together by mini-batch gradient descent in
numpy on a bounded sample of labelled rows. A temperature fitted on held-back
rows of the sample calibrates the probabilities, and a threshold on them marks
predictions that should be rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .phases import ship
from .words import chunks

GRAMS = (2, 4)
BUCKETS = 4096
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
#: Fixed odd multipliers of the subword hash.
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


@dataclass(frozen=True)
class Model:
    """Languages, the product of embeddings and softmax weights (one row per bucket), bias, threshold."""

    languages: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    threshold: float


def subwords(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: the buckets of all n-grams that lie in one row, and that row."""
    codes = _LOWER[data]
    sizes = np.diff(offsets)
    for n in GRAMS:
        if len(codes) < n:
            continue
        h = np.zeros(len(codes) - n + 1, np.uint32)
        for j in range(n):
            h += codes[j : len(codes) - n + 1 + j] * _FACTORS[j] + np.uint32(n)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
        counts = np.maximum(sizes - n + 1, 0)
        row = np.repeat(np.arange(len(sizes)), counts)
        place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[:-1][row]
        yield (h[place] >> np.uint32(20)).astype(np.int64) % BUCKETS, row


def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's subword frequencies as a dense float32 vector, in bytes."""
    for batch in batches:
        for lo, hi, data, offsets in chunks(batch["text"]):
            counts = np.zeros((hi - lo, BUCKETS), np.float32)
            for bucket, row in subwords(data, offsets):
                counts += np.bincount(row * BUCKETS + bucket, minlength=counts.size).reshape(counts.shape)
            counts /= np.maximum(counts.sum(1, keepdims=True), 1)
            yield pa.RecordBatch.from_arrays(
                [batch["lang"].slice(lo, hi - lo), pa.array([c.tobytes() for c in counts], pa.binary())], ["lang", "vector"]
            )


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, classes: int, size: int = 16, epochs: int = 40, batch: int = 32, rate: float = 1.0, seed: int = 7):
    """Embeddings, weights and bias by gradient descent on the cross entropy, with a rate that falls to zero."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 1, (x.shape[1], size)).astype(np.float32)
    w, b = np.zeros((size, classes), np.float32), np.zeros(classes, np.float32)
    steps, step = epochs * -(-len(x) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            rows = order[at : at + batch]
            xb = x[rows]
            mean = xb @ emb
            grad = softmax(mean @ w + b)
            grad[np.arange(len(rows)), y[rows]] -= 1
            grad /= len(rows)
            now = rate * (1 - step / steps)
            back = grad @ w.T
            w -= now * (mean.T @ grad)
            b -= now * grad.sum(0)
            emb -= now * 50 * (xb.T @ back)  # a bucket's share of a text is small
            step += 1
    return emb, w, b


def calibrate(logits: np.ndarray, y: np.ndarray, accuracy: float) -> tuple[float, float]:
    """The temperature of least cross entropy, and the least score above which ``accuracy`` holds."""
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    best = float(grid[int(np.argmin(loss))])
    p = softmax(logits / best)
    score, right = p.max(1), p.argmax(1) == y
    order = np.argsort(-score)
    good = np.cumsum(right[order]) / np.arange(1, len(y) + 1) >= accuracy
    return best, float(score[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0


def fit(docs: DataFrame, learn: Column, per_language: int = 500, languages: int = 64, accuracy: float = 0.99) -> Model | None:
    """A model of the labelled rows where ``learn`` is true, or None if there are none.

    Bounds of the sample: the ``languages`` most frequent values of lang, and
    about ``per_language`` rows of each, drawn by the hash of doc_id.
    """
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return None
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, per_language / r["count"]))])
    draw = F.expr("pmod(xxhash64(doc_id, 11), 1000003)") / 1000003
    sample = rows.where(draw < F.coalesce(F.try_element_at(share, F.col("lang")), F.lit(0.0)))
    found = sample.select("lang", "text").mapInArrow(frequencies, "lang string, vector binary").collect()
    found.sort(key=lambda r: (r["lang"], bytes(r["vector"])))
    names = tuple(sorted({r["lang"] for r in found}))
    if not names:
        return None
    x = np.stack([np.frombuffer(r["vector"], np.float32) for r in found])
    y = np.array([names.index(r["lang"]) for r in found])
    held = np.arange(len(y)) % 5 == 4 if len(y) >= 50 else np.zeros(len(y), bool)
    emb, w, b = train(x[~held], y[~held], len(names))
    back = held if held.any() else ~held
    heat, threshold = calibrate(x[back] @ emb @ w + b, y[back], accuracy)
    return Model(names, (emb @ w / heat).astype(np.float32), (b / heat).astype(np.float32), threshold)


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch["text"]):
                total = np.zeros((hi - lo, len(model.languages)))
                n = np.zeros(hi - lo)
                for bucket, row in subwords(data, offsets):
                    n += np.bincount(row, minlength=hi - lo)
                    for k in range(len(model.languages)):
                        total[:, k] += np.bincount(row, model.weights[:, k][bucket], hi - lo)
                p = softmax(total / np.maximum(n, 1)[:, None] + model.bias)
                said = np.array(model.languages, object)[p.argmax(1)]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, hi - lo), batch["held_out"].slice(lo, hi - lo), batch["letters"].slice(lo, hi - lo), pa.array(said, pa.string()), pa.array(p.max(1))],
                    ["doc_id", "held_out", "letters", "said", "p"],
                )

    return run


def identify(docs: DataFrame, held_out: Column, **bounds) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) for every row.

    ``held_out`` marks rows that nothing is learned from. The prediction reads the
    whole text only. A null text or one without a letter gets ``und`` and score
    0; so does every text if no labelled row can be learned from. ``rejected`` is
    true for those and for scores under the calibrated threshold. Repeated rows
    get equal results; an empty table gives an empty one; other columns are ignored.
    """
    ship(docs.sparkSession)
    held_out = F.coalesce(held_out, F.lit(False))
    model = fit(docs, ~held_out, **bounds)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", held_out.alias("held_out"), letters.alias("letters"), "text")
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    said = rows.mapInArrow(_predict(model), f"doc_id {kind}, held_out boolean, letters boolean, said string, p double")
    return said.select(
        "doc_id",
        "held_out",
        F.when(F.col("letters"), F.col("said")).otherwise("und").alias("lang_pred"),
        F.when(F.col("letters"), F.least("p", F.lit(1.0))).otherwise(0.0).alias("score"),
        (~F.col("letters") | (F.col("p") < model.threshold)).alias("rejected"),
    )
