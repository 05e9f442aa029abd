"""Centroid clustering, spelling variants and the URL filter against brute force on odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from petrichor.llm import centroid_clustering, spelling_variants, url_filter
from petrichor.llm.phases import Phases

# Centroid clustering --------------------------------------------------------


def brute_clusters(rows, clusters, rounds, width, scale):
    kept = []
    for vec_id, e in rows:
        if e is not None and len(e) == width and all(x is not None and math.isfinite(x) and abs(x) < 1 << 21 for x in e):
            kept.append((vec_id, [math.floor(scale * x) for x in e]))
    hashed = sorted((hashlib.sha256(f"1:{v}".encode()).hexdigest(), x) for v, x in kept if v is not None)
    centroids = [x for _, x in hashed[:clusters]]
    if not centroids:
        return []
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, x in kept:
            groups[near(x)[1]].append(x)
        centroids = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else old for k, old in enumerate(centroids)]
    last = [(v, *near(x)) for v, x in kept]
    own = Counter()
    for _, d, k in last:
        own[k] += d
    return [(v, k, d, own[k], sum(own.values()), centroids[k]) for v, d, k in last]


def vectors(spark, rows):
    table = [(v, e, 1, 2, [3]) for v, e in rows]
    return spark.createDataFrame(table, "vec_id long, embedding array<double>, cluster int, distance int, x array<int>").repartition(3)


def test_clusters_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, [round(rng.gauss(i % 3, 1), 2) for _ in range(4)]) for i in range(150)]
    rows += [(i, [0.25 * rng.randrange(-2, 3) for _ in range(4)]) for i in range(150, 220)]  # many ties
    rows += [rows[0], (3, [9.0] * 4), (None, [0.5] * 4), (400, None), (401, []), (402, [1.0] * 3), (403, [1.0, None, 1.0, 1.0])]
    rows += [(404, [1.0, math.nan, 1.0, 1.0]), (405, [math.inf, 0.0, 0.0, 0.0]), (406, [1e30, 0.0, 0.0, 0.0]), (407, [2.0**20, 0.0, 0.0, -(2.0**20)])]
    for clusters, rounds in ((16, 3), (1, 2), (5, 0)):
        got = centroid_clustering.clustered(vectors(spark, rows), clusters, rounds, width=4, scale=64).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_clusters(rows, clusters, rounds, 4, 64)))


def test_clusters_of_few_no_and_nameless_vectors(spark):
    few = [(1, [0.0, 1.0]), (2, [0.0, 1.0])]
    got = centroid_clustering.clustered(vectors(spark, few), 16, 3, width=2).collect()
    assert sorted((r.vec_id, r.cluster, r.distance, r.inertia) for r in got) == [(1, 0, 0, 0), (2, 0, 0, 0)]
    for rows in ([], [(None, [0.0, 1.0])], [(1, [1.0])]):
        out = centroid_clustering.clustered(vectors(spark, rows), width=2)
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"] and not out.collect()


def test_threshold_walk_is_exact_in_small_steps(monkeypatch):
    rng = np.random.default_rng(3)
    for d, k in ((1, 1), (1, 7), (3, 20), (12, 5)):
        points, centroids = rng.integers(-4, 5, (300, d)), rng.integers(-4, 5, (k, d))
        exact = ((points[:, None] - centroids[None]) ** 2).sum(2)
        for cells in (1, 1 << 22):
            monkeypatch.setattr(centroid_clustering, "CELLS", cells)
            number, distance = centroid_clustering.nearest(points, centroids)
            assert (number == exact.argmin(1)).all() and (distance == exact.min(1)).all()


# Spelling variants ----------------------------------------------------------


def edits_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(docs, least_chars, least_n, ratio, every):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if every and doc is not None and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least_chars and k >= least_n}
    form, out = {}, []
    near = {w: [o for o in n if edits_one(w, o)] for w in n}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return out


def word_docs():
    rng = random.Random(8)
    bases = ["wordlike", "Ärgerlich", "über", "straße", "naïveté", "letters", "lettera", "aabbcc", "abcabc", "x" * 700]
    docs = []
    for i in range(60):
        words = []
        for _ in range(60):
            w = rng.choice(bases[: 1 + rng.randrange(len(bases))])
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abßÉz") + w[at:], w[:at] + rng.choice("abßÉz") + w[at + 1 :], w.upper()])
            words.append(w)
        docs.append((i, rng.choice([" ", ", ", "\n", "-1 "]).join(words)))
    return docs + [(None, docs[0][1]), (7, docs[1][1]), docs[2], docs[2], (99, None), (100, ""), (101, "123 -- 日本")]


def doc_table(spark, docs):
    return spark.createDataFrame([(d, t, "w", 1, 2) for d, t in docs], "doc_id long, text string, word string, n int, form int").repartition(4)


@pytest.mark.parametrize("tile,held,every", [(2048, 200_000, 0), (3, 10, 7)])
def test_variants_equal_brute_force(spark, monkeypatch, tile, held, every):
    monkeypatch.setattr(spelling_variants, "TILE_WORDS", tile)
    docs = word_docs()
    got = spelling_variants.spelling_variants(doc_table(spark, docs), 4, 2, 3, every)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute_variants(docs, 4, 2, 3, every)))


def test_task_passes_counts_on_in_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(spelling_variants, "HELD", 3)
    docs = word_docs()
    batches = [pa.RecordBatch.from_arrays([pa.array([None if d is None else str(d) for d, _ in docs], pa.string()), pa.array([t for _, t in docs], pa.string())], ["doc_id", "text"])] * 2
    n, parts = Counter(), list(spelling_variants._counted(4, 0)(iter(batches)))
    for part in parts:
        for w, k in zip(part["word"].to_pylist(), part["n"].to_pylist()):
            n[w] += k
    assert len(parts) > 2 and dict(n) == {w: 2 * k for w, k, *_ in brute_variants(docs, 4, 1, 3, 0)}


def test_roots_follow_long_chains(spark):
    rows = [(f"w{i}", f"w{i + 1}") for i in range(11)] + [("a", "w3")]
    forms = Phases(spark, "t").land(spark.createDataFrame(rows, "word string, form string"), "forms")
    assert {r.root for r in spelling_variants.roots(forms, Phases(spark, "t")).collect()} == {"w11"}


def test_no_words(spark):
    assert not spelling_variants.spelling_variants(doc_table(spark, [(1, None), (2, "short")])).collect()
    assert not spelling_variants.spelling_variants(doc_table(spark, [(1, "x")]).where("false")).collect()


# URL filter -----------------------------------------------------------------


def brute_parts(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path, rules):
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text), default=None)


def brute_text(url):
    url = url or ""
    at = url.find("://")
    if at >= 0:
        host = re.match(r"[^/?#]*", url[at + 3 :])[0]
        url = url[: at + 3] + brute_parts(url)[0] + url[at + 3 + len(host) :]
    return "".join(c if " " <= c <= "~" else "\x1f" for c in url)


def brute_differences(texts, sides, order, contexts, least):
    """Per text, by dictionaries of contexts: the longest kept suffix of what stands before each character."""
    counts = [defaultdict(Counter), defaultdict(Counter)]
    for text, side in zip(texts, sides):
        if side is None:
            continue
        padded = url_filter.PAD * order + text + url_filter.LAST
        for i in range(order, len(padded)):
            for k in range(order + 1):
                counts[side][padded[i - k : i]][padded[i]] += 1
    total = Counter({c: sum(counts[0][c].values()) + sum(counts[1][c].values()) for c in {*counts[0], *counts[1]}})
    kept = set(sorted((c for c in total if total[c] >= least or not c), key=lambda c: (-total[c], len(c), c))[:contexts])

    def chance(side, context, c):
        below = 1 / url_filter.SYMBOLS if not context else chance(side, context[1:], c)
        seen = counts[side][context]
        return (seen[c] + len(seen) * below) / (sum(seen.values()) + len(seen)) if seen else below

    out = []
    for text in texts:
        padded, gain = url_filter.PAD * order + text + url_filter.LAST, 0.0
        for i in range(order, len(padded)):
            context = next(padded[i - k : i] for k in range(order, -1, -1) if padded[i - k : i] in kept)
            gain += math.log(chance(1, context, padded[i])) - math.log(chance(0, context, padded[i]))
        out.append(gain / (len(text) + 1))
    return out


def urls():
    rng = random.Random(2)
    hosts = ["a.net", "B.example.NET", "example.net", "x.example.com", "example.com", "news.org", "notnet", "cheap.com", "net", "xn--ü.org"]
    tails = ["", "/", "/en/1", "/en", "/fr/2?x=/de/", "/de/9#top", "?q=/en/", "#/fr/", "/FR/1", "/fr/" + "z" * 300]
    out = [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(hosts)}{rng.choice(tails)}" for _ in range(400)]
    return out + [None, "", "no scheme", "://", "a://b://c/en/", "http://user@a.net:80/x", "http://a.net\n/x", "q?://Net/en/"]


def page_table(spark, found):
    return spark.createDataFrame([(i, u, "h", 1, True) for i, u in enumerate(found)], "page_id long, url string, host string, score int, text boolean").repartition(3)


@pytest.mark.parametrize("order,contexts,least", [(4, 1024, 8), (2, 30, 1), (0, 10, 1)])
def test_urls_equal_brute_force(spark, order, contexts, least):
    found = urls()
    got = {r.page_id: r for r in url_filter.judged(page_table(spark, found), order=order, contexts=contexts, least=least).collect()}
    split = [brute_parts(u) for u in found]
    rules = [brute_rule(*s, url_filter.RULES) for s in split]
    texts = [brute_text(u) for u in found]
    folds = {r.text: r.fold for r in spark.createDataFrame([(t,) for t in set(texts)], "text string").selectExpr("text", "pmod(xxhash64(text, 29), 5) AS fold").collect()}
    sides = [None if r is None or folds[t] == 0 else int(r.allow) for r, t in zip(rules, texts)]
    gains = brute_differences(texts, sides, order, contexts, least)
    bins = Counter((r.allow, round(max(-32, min(32, g)) * 64)) for r, g, t in zip(rules, gains, texts) if r and folds[t] == 0)
    slope, shift = url_filter.calibration([(a, b, n) for (a, b), n in sorted(bins.items())])
    for i, (rule, gain) in enumerate(zip(rules, gains)):
        row, score = got[i], 1 / (1 + math.exp(-(slope * gain + shift)))
        assert (row.host, row.path, row.rule) == (*split[i], rule.text if rule else None)
        assert abs(row.score - score) < 1e-3
        if rule or abs(score - 0.5) > 1e-3:
            assert row.verdict == ("allow" if (rule.allow if rule else score >= 0.5) else "block")
    assert len(got) == len(found)


def test_calibration_is_the_best_logistic_fit():
    bins = [(True, 60, 30), (True, -10, 5), (False, -70, 20), (False, 20, 6)]
    slope, shift = url_filter.calibration(bins)
    up, down = 36 / 37, 1 / 28

    def loss(a, b):
        return sum(n * (math.log1p(math.exp(a * x / 64 + b)) - (up if y else down) * (a * x / 64 + b)) for y, x, n in bins)

    best = loss(slope, shift)
    assert all(best <= loss(slope + a, shift + b) for a in (-0.01, 0, 0.01) for b in (-0.01, 0, 0.01))
    assert url_filter.calibration([(True, 5, 3)]) == (1.0, 0.0)


def test_urls_without_two_sides(spark):
    for found in (["http://a.com/x", None], ["http://a.net/x", "http://b.com/q"], []):
        got = url_filter.judged(page_table(spark, found)).collect()
        assert len(got) == len(found)
        assert all(r.score == 0.5 and r.verdict == ("block" if r.rule else "allow") for r in got)


@pytest.mark.parametrize("order,least,states", [(4, 2, 40), (3, 1, 1)])
def test_every_context_counts_whatever_the_automaton_holds(spark, monkeypatch, order, least, states):
    monkeypatch.setattr(url_filter, "STATES", states)
    test_urls_equal_brute_force(spark, order, None, least)
    found = page_table(spark, urls())
    parts = [sorted(map(repr, url_filter.judged(found, order=order, least=least).collect()))]
    monkeypatch.setattr(url_filter, "STATES", 1 << 20)
    parts.append(sorted(map(repr, url_filter.judged(found, order=order, least=least).collect())))
    assert parts[0] == parts[1]
