"""Each operator against brute force on small odd tables: nulls, empty and long texts, repeats, clashing columns."""

import hashlib
import json
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from petrichor.llm import (
    embedding_dedup,
    language_id,
    line_dedup,
    mixing,
    packing,
    quality_rules,
    simhash_dedup,
    substring_dedup,
    suffix_dedup,
    toxicity,
)
from petrichor.llm.phases import Phases
from petrichor.llm.suffix_sort import deep_shallow

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns whose names the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, words string, h long, gone int"


def texts():
    rng = random.Random(4)
    vocabulary = ["alpha", "beta", "über", "né", "x", "#", "end.", "Große", "日本", "loser"]
    base = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (0, 1, 2, 9, 40, 70, 90, 120)]
    shared = " ".join(f"w{i}" for i in range(60))
    long = " ".join(rng.choice(vocabulary) for _ in range(6000))
    out = [None, "", " \t\n", "one", *base, base[5], base[6] + " tail", shared, "lead " + shared + " trail"]
    out += [f"{shared}\n{base[4]}", long, long[:300] + "?" + long[300:], "a\n\nb\x0bc\rd", "same line of some length here\n" * 12]
    out += ["same line of some length hers\nother", "é" * 200, "é" * 199 + "e", "!!! $$$ ###", shared + "\n" + shared]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "w", 1, 2) for i, t in enumerate(texts())]
    rows += [(None, rows[6][1], None, None, None, None), rows[9], (5, "another text under a used id", None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def by_id(rows, *names):
    return sorted((tuple(r[n] for n in ("doc_id", *names)) for r in rows), key=repr)


def expected_removal(units_of, width, docs):
    """(doc_id, units, removed flags) by a dictionary of all windows."""
    first: dict = {}
    rows = [(i, units_of(t)) for i, t in rows_of(docs)]
    for i, u in rows:
        if i is not None:
            for s in range(len(u) - width + 1):
                key = tuple(u[s : s + width])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, u in rows:
        gone = [False] * len(u)
        if i is not None:
            for s in range(len(u) - width + 1):
                if first[tuple(u[s : s + width])] < i:
                    gone[s : s + width] = [True] * width
        out.append((i, u, gone))
    return out


def test_substring_dedup(docs, empty):
    for window in (50, 10):
        want = [(i, len(u), sum(g), " ".join(w for w, x in zip(u, g) if not x)) for i, u, g in expected_removal(WORD.findall, window, docs)]
        found = substring_dedup.remove_repeated_words(docs, window).collect()
        assert by_id(found, "n_words", "n_removed", "kept") == sorted(want, key=repr)
    assert substring_dedup.remove_repeated_words(empty).count() == 0


def test_covers_are_difference_covers():
    for period, cover in substring_dedup.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_suffix_dedup(docs, empty, monkeypatch):
    want = []
    for i, u, g in expected_removal(lambda t: t.encode(), 50, docs):
        spans = sum(x and (k == 0 or not g[k - 1]) for k, x in enumerate(g))
        want.append((i, len(u), sum(g), spans, bytes(b for b, x in zip(u, g) if not x)))
    found = [r.asDict() | {"kept": bytes(r.kept)} for r in suffix_dedup.remove_repeated_bytes(docs).collect()]
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "kept") == sorted(want, key=repr)
    monkeypatch.setattr(suffix_dedup, "TILE_CLASSES", 1)  # every contested gram is dealt into tiles and merged
    found = [r.asDict() | {"kept": bytes(r.kept)} for r in suffix_dedup.remove_repeated_bytes(docs).collect()]
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "kept") == sorted(want, key=repr)
    assert suffix_dedup.remove_repeated_bytes(empty).count() == 0


@pytest.mark.parametrize("alphabet,depth", [(2, 20), (4, 50), (200, 7)])
def test_deep_shallow_order(alphabet, depth):
    rng = np.random.default_rng(alphabet)
    data = rng.integers(0, alphabet, 3000).astype(np.uint8)
    data[800:1400] = data[100:700]
    starts = rng.permutation(len(data) - depth)
    order, group = deep_shallow(data, starts, depth)
    keys = [bytes(data[s : s + depth]) for s in starts[order]]
    assert keys == sorted(keys)
    assert [a == b for a, b in zip(keys, keys[1:])] == (np.diff(group) == 0).tolist()


def fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_simhash(spark, docs, empty):
    rows = rows_of(docs)
    prints: dict = {}
    for i, t in rows:
        if i is not None:
            prints.setdefault(i, []).append(fingerprint(t))
    parts = components(list(prints), lambda a, b: any(bin(x ^ y).count("1") <= 3 for x in prints[a] for y in prints[b]))
    want = [(i, fingerprint(t), None if i is None else parts[i]) for i, t in rows]
    found = [r.asDict() | {"bits": r.bits % 2**64} for r in simhash_dedup.near_duplicates(docs).collect()]
    assert by_id(found, "bits", "component_id") == sorted(want, key=repr)
    assert simhash_dedup.near_duplicates(empty).count() == 0


def test_simhash_blocks_meet_all_close_pairs(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 3))) for b in base]
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    df = spark.createDataFrame([(signed(a), signed(b)) for a, b in zip(base, near)], "a long, b long")
    keys = [F.array(*simhash_dedup.block_keys(F.col(c), 3)) for c in "ab"]
    assert df.where(~F.arrays_overlap(*keys)).count() == 0


def test_key_tiles_cut_large_keys(spark):
    from petrichor.llm.tiles import forest, key_tiles

    rows = spark.createDataFrame([(k, v) for k, n in ((1, 90), (2, 3), (3, 1)) for v in range(n)], "k long, v long")
    task = forest(lambda a, b: np.abs(a - b) == 1)
    links = key_tiles(rows, "k", "v", Phases(spark, "test"), task, tile_rows=16).collect()
    parts = components(range(90), lambda a, b: any({r.u, r.v} == {a, b} for r in links))
    assert set(parts.values()) == {0} and all(abs(r.u - r.v) == 1 for r in links)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_line_dedup(spark, empty):
    rng = random.Random(9)
    line = "the quick brown fox jumps over the lazy dog nr 7"
    changed = lambda n: "".join(c if rng.random() > n / len(line) else rng.choice(["", "é", c + "z"]) for c in line)
    rows = [(i, "\n".join([changed(rng.choice([0, 1, 2, 4])) for _ in range(3)] + ["short", ""])) for i in range(12)]
    rows += [(20, None), (21, ""), (22, line), (22, line), (22, line + "\nmore"), (None, line)]
    df = spark.createDataFrame([(i, t, "en", "w", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    seen = sorted(((i, p, x) for i, t in rows if i is not None and t is not None for p, x in enumerate(t.split("\n")) if len(x) >= 24), key=repr)
    seen.sort(key=lambda s: (s[0], s[1]))

    def gone(i, p, x):
        return i is not None and len(x) >= 24 and any((j, q) < (i, p) and abs(len(x) - len(y)) <= 2 and edits(x, y) <= 2 for j, q, y in seen)

    want = []
    for i, t in rows:
        lines = [] if t is None else t.split("\n")
        kept = [x for p, x in enumerate(lines) if not gone(i, p, x)]
        want.append((i, None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    found = line_dedup.without_similar_lines(df)
    assert found.columns == [*df.columns, "__l_lines", "__l_removed"]
    assert by_id(found.collect(), "text", "__l_lines", "__l_removed") == sorted(want, key=repr)
    assert line_dedup.without_similar_lines(empty).count() == 0


def test_banded_edit_distance(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abé😀") for _ in range(rng.randint(8, 50)))
    rows = []
    for _ in range(300):
        a = word()
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(b))
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "😀"])
        rows.append((a, "".join(b), edits(a, "".join(b))))
    df = spark.createDataFrame(rows, "a string, b string, d int")
    for k in (1, 3):
        close = df.select("d", F.split("a", "").alias("a"), F.split("b", "").alias("b")).where(F.abs(F.size("a") - F.size("b")) <= k)
        wrong = close.withColumn("e", line_dedup.edit_distance(F.col("a"), F.col("b"), k)).where(
            ((F.col("d") <= k) & (F.col("e") != F.col("d"))) | ((F.col("d") > k) & (F.col("e") <= k))
        )
        assert wrong.count() == 0


def test_quality_rules(docs, empty):
    found = quality_rules.judged(docs)
    assert found.columns[:6] == docs.columns
    for r in found.collect():
        words = WORD.findall(r.text or "")
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)} if len(words) < 500 else None
        lines = [x for x in (r.text or "").split("\n") if WORD.search(x)]
        assert r["__q_n"] == len(words) and r["__q_chars"] == sum(map(len, words))
        assert r["__q_symbols"] == sum((r.text or "").count(c) for c in "#*$%&|<>")
        assert r["__q_dup_lines"] == len(lines) - len(set(lines))
        assert covered is None or r["__q_repeat"] == len(covered)
        assert r["__q_base_failed"] == (len(words) < 10 or 100 * r["__q_repeat"] > 20 * len(words))
        assert r["__q_kept"] == (not r["__q_base_failed"] and r["__q_rule"] is None)
    kept = quality_rules.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == found.where("__q_kept").count()
    assert quality_rules.judged(empty).count() == 0


def test_cascade_goes_by_rejections_per_cost(spark):
    rows = spark.range(20000).select("id")
    order = quality_rules.cascade_order(rows, {"never": F.col("id") < 0, "often": F.col("id") > 5, "seldom": F.col("id") == 3})
    assert order[0] == "often" and order[-1] == "never"


def words_in(lang, n, rng):
    return " ".join(rng.choice({"en": ["the", "thing", "with", "her"], "de": ["der", "schön", "nicht", "auch"]}[lang]) for _ in range(n))


def test_language_id(spark, empty):
    rng = random.Random(1)
    rows = [(i, words_in(l, 30, rng), l) for i, l in enumerate(["en", "de"] * 60)] + [(900, None, "en"), (901, "12 ?!", None), (902, words_in("de", 9, rng), None), (902, "x", None)]
    df = spark.createDataFrame([(i, t, l, "w", 1, 2) for i, t, l in rows], SCHEMA)
    found = language_id.identify(df, F.col("doc_id") % 3 == 1).collect()
    assert len(found) == len(rows)
    said = {r.doc_id: r for r in found}
    assert all(said[i].lang_pred == l for i, t, l in rows if l and i < 900)
    assert all(said[i].lang_pred == "und" and said[i].score == 0 and said[i].rejected for i in (900, 901))
    assert all(0 <= r.score <= 1 for r in found)
    assert language_id.identify(empty, F.lit(False)).count() == 0


def test_toxicity(spark, empty):
    rng = random.Random(2)
    bad = ["loser", "idiot", "scum"]
    rows, marks = [], []
    for i in range(200):
        toxic = i % 4 == 0
        words = words_in("en", 40, rng).split() + ([rng.choice(bad), rng.choice(bad)] if toxic else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    rows += [(300, None), (301, ""), (301, "loser loser"), (None, "you idiot")]
    marks += [(5, 1, None), (None, 0, 1)]
    df = spark.createDataFrame([(i, t, "en", "w", 1, 2) for i, t in rows], SCHEMA)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = toxicity.score_toxicity(df, labels, F.col("doc_id") % 5 == 2).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out and r.doc_id < 200]
    assert held and all(r.predicted == (r.doc_id % 4 == 0) for r in held)
    assert {r.predicted for r in found if r.doc_id == 300} == {0}
    assert all(e.toxic in (0, 1) and e.doc_id % 5 != 2 for r in found for e in r.evidence)
    assert toxicity.score_toxicity(empty, labels, F.lit(False)).count() == 0


def test_block_max_neighbours_are_exact():
    rng = np.random.default_rng(0)
    weights = rng.random((30, 256)) * (rng.random((30, 256)) < 0.1)
    tops = weights.reshape(30, 4, 64).max(2)
    index = toxicity.Index(np.zeros(30, np.uint64), np.ones(30), weights, tops, np.arange(256), np.zeros(256), np.ones(256), 7)
    for _ in range(20):
        number = rng.choice(30, 5, replace=False)
        weight = rng.random(5)
        cosine, who = index.nearest(number, weight)
        full = weight @ weights[number]
        want = np.lexsort((np.arange(256), -full))[:7]
        assert np.allclose(cosine, full[want][full[want] > 0])


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


def test_embedding_dedup(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    vectors = [(i, (centres[i % 6] + rng.normal(scale=0.12, size=8)).astype(np.float32).tolist(), i % 2) for i in range(90)]
    vectors += [(100 + i, vectors[3][1], 1) for i in range(5)] + [(200, None, 1), (201, [0.0] * 8, 1), (202, [1.0, None], 1), (203, [float("nan")] * 8, 1)]
    vectors += [(204, [float("inf")] * 8, 1), (205, vectors[3][1], None), (206, [1.0, 2.0], 1), (207, [], 0)]
    df = spark.createDataFrame([(*v, "x") for v in vectors], "vec_id long, embedding array<float>, label int, node string").repartition(4)
    good = {i: (e, l) for i, e, l in vectors if l is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)}
    linked = lambda a, b: a in good and b in good and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0]) and cosine(good[a][0], good[b][0]) >= 0.93
    ids = [v[0] for v in vectors]
    parts = components(ids, linked)
    want = sorted((i, sum(linked(i, j) for j in ids if j != i), parts[i], parts[i] == i) for i in ids)
    for tile in (1024, 8):
        monkeypatch.setattr(embedding_dedup, "TILE_ROWS", tile)
        found = embedding_dedup.near_duplicates(df).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == want
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_packing_round_trip(docs, empty):
    from tokenizers import Tokenizer

    odd = docs.sparkSession.createDataFrame(
        [(70, "it's I'VE  don't x…—y é Ⅷ <|endoftext|>end 12٣  ßẞ"), (71, "<|endoftext|>")], "doc_id long, text string"
    )
    df = docs.select("doc_id", "text").union(odd)
    pieces = packing.pack(df, packing.default_tokenizer(), size=256).collect()
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    sequences: dict = {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256 and end & (end - 1) == 0
    want = sorted((i if i is not None else -1, [*tokenizer.encode(t, add_special_tokens=False).ids, 2]) for i, t in rows_of(df))
    by_doc: dict = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id is None, p.start)):
        by_doc.setdefault((-1 if p.doc_id is None else p.doc_id, p.doc_tokens), []).append((p.start, np.frombuffer(p.ids, "<u4").tolist()))
    total = sum(p.length for p in pieces)
    assert total == sum(len(ids) for _, ids in want)
    for i, ids in want:
        parts = by_doc[i, len(ids)]
        assert all(ids[s : s + len(x)] == x for s, x in parts if len([1 for j, other in want if (j, len(other)) == (i, len(ids))]) == 1)
    assert packing.pack(empty, packing.default_tokenizer()).count() == 0


def test_bm25_neighbours():
    docs = [[1, 2, 3, 3], [1, 9, 9, 9], [2, 3, 3, 7], [5, 6]]
    ids, bounds = np.array(sum(docs, []), np.int32), np.cumsum([0, *map(len, docs)])
    shard = packing.Shard(ids, bounds)
    shard.used[0] = True
    n, mean = len(docs), np.mean([len(d) for d in docs])

    def score(q, d):
        return sum(math.log1p((n - df + 0.5) / (df + 0.5)) * d.count(t) * 2.2 / (d.count(t) + 1.2 * (0.25 + 0.75 * len(d) / mean)) for t in set(q) if (df := sum(t in x for x in docs)))

    assert shard.neighbours(np.array(docs[0])).tolist() == sorted([1, 2, 3], key=lambda k: -score(docs[0], docs[k]))


def test_mixing(spark, empty):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(300):
        low = i % 3 == 0
        rows.append((i, words_in("en", 20, rng) + (" junkword spamspam" if low else " finetext")))
        marks.append((i, "low" if low else "good"))
    rows += [(400, None), (401, ""), (7, "repeated id")]
    df = spark.createDataFrame([(i, t, "en", "w", 1, 2) for i, t in rows], SCHEMA)
    labelled = spark.createDataFrame([*marks, (None, "good"), (3, None), (0, "low")], "doc_id long, domain string")
    shares = {"good": 0.9, "low": 0.1}
    out, domains = mixing.rated(df, labelled, shares, "good", Phases(spark, "test"))
    assert domains == ("good", "low") and out.columns[:6] == df.columns
    found = out.collect()
    assert len(found) == len(rows) and all(r["__m_rate"] >= 0 for r in found)
    t = np.array([r["__m_tokens"] for r in found], float)
    p = np.array([r["__m_p"] for r in found])
    rates = np.array([r["__m_rate"] for r in found])
    totals = (rates * t) @ p
    assert np.allclose(totals / totals.sum(), [0.9, 0.1], atol=2e-3) and np.allclose(p.sum(1), 1)
    assert totals[0] == pytest.approx(t @ p[:, 0], rel=2e-3)
    copies = mixing.mixed(df, labelled, shares, "good")
    assert copies.columns == df.columns
    n = {(r.doc_id, r.text): r["count"] for r in copies.groupBy("doc_id", "text").count().collect()}
    for r in found:
        assert math.floor(r["__m_rate"]) <= n.get((r.doc_id, r.text), 0) <= math.ceil(r["__m_rate"])
    assert mixing.mixed(empty, labelled, shares, "good").count() == 0
    assert mixing.mixed(df, labelled.limit(0), shares, "good").count() == len(rows)
