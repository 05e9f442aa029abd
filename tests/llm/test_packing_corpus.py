"""Packing retrieves over the corpus: content and not file order decides which documents share a shard."""

import random

import numpy as np
import pytest

from petrichor.llm import packing

TOKENIZER = packing.default_tokenizer()


@pytest.fixture(scope="module")
def topics(spark):
    """480 texts of eight topics in mixed order: a topic has words of its own, and all share common ones."""
    rng = random.Random(12)
    words = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(500)]
    rows = []
    for i in range(480):
        own = words[40 * (i % 8) : 40 * (i % 8) + 40]
        rows.append((i, " ".join(rng.choice(own if rng.random() < 0.7 else words[320:]) for _ in range(60))))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string")


def _sequences(rows):
    out = {}
    for r in rows:
        out.setdefault(r.sequence_id, set()).add(r.doc_id)
    return out


def _whole(rows):
    """Every document's pieces are gapless, and so is every sequence."""
    docs, places = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in docs.values():
        pieces.sort()
        assert [p[0] for p in pieces] == np.append(0, np.cumsum([p[1] for p in pieces]))[:-1].tolist()
        assert sum(p[1] for p in pieces) == pieces[0][2]
    for pieces in places.values():
        pieces.sort()
        assert [p[0] for p in pieces] == np.append(0, np.cumsum([p[1] for p in pieces]))[:-1].tolist()


@pytest.mark.parametrize("parts", [3, 7])
def test_sequences_hold_one_topic_whatever_the_files(topics, parts):
    rows = packing.pack(topics.repartition(parts), TOKENIZER, size=1024, shard_tokens=16384).collect()
    _whole(rows)
    assert {r.doc_id for r in rows} == set(range(480))
    shares = [max(sum(d % 8 == t for d in docs) for t in range(8)) / len(docs) for docs in _sequences(rows).values() if len(docs) > 3]
    assert len(shares) > 20 and np.mean(shares) > 0.8


def test_corpus_numbers(spark, topics):
    """Shard weights from the corpus equal BM25 written out, for one shard of everything."""
    ids = np.array([5, 5, 7, 2, 7, 9, 2, 2], np.int32)
    bounds = np.array([0, 4, 7, 8])
    df = np.array([0, 0, 30, 0, 0, 4, 0, 9, 0, 2])
    idf = np.log1p((40 - df + 0.5) / (df + 0.5))
    shard = packing.Shard(ids, bounds, packing.Corpus(idf, 3.5))
    for term, doc, weight in zip(shard.term, shard.doc, shard.weight):
        length = bounds[doc + 1] - bounds[doc]
        times = int((ids[bounds[doc] : bounds[doc + 1]] == term).sum())
        assert weight == pytest.approx(idf[term] * times * 2.2 / (times + 1.2 * (0.25 + 0.75 * length / 3.5)))


def test_copies_of_one_text_are_split(spark):
    rows = [(i % 50 if i % 3 else None, "the same text again and again " * 20) for i in range(300)] + [(1000, None), (1001, "")]
    found = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER, size=512, shard_tokens=4096).collect()
    total = sum(r.length for r in found)
    ids = packing.pack(spark.createDataFrame(rows[:1], "doc_id long, text string"), TOKENIZER).collect()
    assert total == 300 * ids[0].doc_tokens + 2
    assert len({r.sequence_id >> 32 for r in found}) > 1


def test_axes_and_medians_come_from_every_row(spark):
    """Along each axis the median of all rows parts them in halves, and the axes are those of all rows' moments."""
    rng = random.Random(3)
    # more rows than fit a sample of 2,000, the last of them of words that no other has
    rows = [(i, " ".join(rng.choice(["house", "tree", "river", "cloud", "stone"][i % 3 :]) + str(rng.randrange(9)) for _ in range(8))) for i in range(2600)]
    rows += [(i, " ".join(rng.choice(["zebra", "quartz", "violin"]) for _ in range(8))) for i in range(2600, 2700)]
    width = np.dtype("<u2")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    landed = docs.mapInArrow(packing._tokens(TOKENIZER, 2, width), "doc_id long, ids binary").cache()
    ids = [np.frombuffer(r.ids, width).astype(np.int32) for r in landed.collect()]
    bounds = np.append(0, np.cumsum([len(i) for i in ids]))
    df = np.zeros(49408)
    for i in ids:
        df[np.unique(i)] += 1
    router = packing._router(landed, width, df, len(ids))
    x = np.rint(np.concatenate(list(router.vectors(np.concatenate(ids), bounds, 100))) * packing.STEPS)
    spread = np.linalg.eigvalsh(x.T @ x - np.outer(x.sum(0), x.sum(0)) / len(x))[::-1][: packing.AXES]
    centred = (x - x.mean(0)) @ router.axes
    assert np.allclose((centred**2).sum(0), spread, rtol=1e-6, atol=spread[0] * 1e-9)
    places = router.places(np.concatenate(ids), bounds)
    assert ((places > router.medians).sum(0) <= len(ids) / 2).all() and ((places >= router.medians).sum(0) >= len(ids) / 2).all()


def test_words_tokenized_together_equal_words_alone():
    tokens = packing.WordTokens(TOKENIZER)
    words = ["it's", "Straße", "été", "́x", "a b", "x" * 300, "\U0001f600\U0001f601", "<|endoftext|>", "a<|endoftext|>b", " ", "12,345.6", "ΑΣ", "'ll", "\x00", "日本語"] * 50
    ids, size = tokens.encoded(words)
    alone = [e.ids for e in tokens.tokenizer.encode_batch(words, add_special_tokens=False)]
    assert size.tolist() == [len(i) for i in alone] and ids.tolist() == [t for i in alone for t in i]
