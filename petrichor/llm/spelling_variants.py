"""Spelling variants: words one edit apart, by blocked Gram matrices of letter counts.

An inserted or deleted code point moves one letter count by one, a replaced one
moves two, so near words have letter-count vectors at a squared distance of one
or two. A block holds the words of one length and of equal counts of three
letter classes; words one edit apart lie in one block or in blocks next to each
other. Blocks are cut into tiles; the product of two tiles' count matrices gives
all squared distances at once, pairs at two or less are verified letter by
letter, and a task returns one row for each word with its number of near words and
the most frequent of them, never a row for each pair.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .phases import Phases

#: Letters of the counted classes; all others are the last one.
CLASSES = ("eau", "tinb", "osrdy")
#: Words of a tile, fewer if they are so long that this many characters are passed.
TILE_WORDS, TILE_CHARS = 2048, 1 << 23
#: Rows of a Gram matrix worked on at once, and characters of pairs verified at once.
GRAM_ROWS, CHECKED = 512, 1 << 22
#: Different words a task counts before it passes them on.
HELD = 200_000


def misspelled(run: str, doc: str | None, every: int) -> str:
    """The run, or in one of ``every`` (document, run) the run without one letter."""
    if doc is None or not every:
        return run
    h = zlib.crc32(run.encode(), zlib.crc32(f"{doc}:".encode()))
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(least_chars: int, every: int):
    run_of = re.compile("[a-zÀ-ÿ]{%d,}" % least_chars)

    def table(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            lowered = pc.ascii_lower(batch["text"])
            for doc, text in zip(batch["doc_id"].to_pylist(), lowered):
                runs = Counter(m[0] for m in run_of.finditer(text.as_py() or ""))
                for word, n in runs.items():
                    counts[misspelled(word, doc, every)] += n
                if len(counts) > HELD:
                    yield table(counts)
                    counts = Counter()
        yield table(counts)

    return run


def vocabulary(docs: DataFrame, least_chars: int, least_n: int, every: int) -> DataFrame:
    """(word, n): words of ``least_chars`` letters or more that stand ``least_n`` times or more."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = rows.mapInArrow(_counted(least_chars, every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.where((F.col("n") >= least_n) & (F.length("word") >= least_chars))


def block_of(word: Column) -> Column:
    """Length and class counts."""
    kept = [F.length(F.translate(word, "".join(CLASSES).replace(c, ""), "")) for c in CLASSES]
    other = F.length(F.translate(word, "".join(CLASSES), ""))
    return F.struct(F.length(word).alias("n"), *[(x - other).alias(f"c{i}") for i, x in enumerate(kept)])


def blocks_below() -> list[tuple[int, ...]]:
    """What to add to a word's block for each block that it is compared in: its own, and one of each two that are next to each other."""
    width = len(CLASSES)
    unit = [tuple(int(i == j) for i in range(width)) for j in range(width + 1)]  # the last class isn't counted
    shorter = [(-1, *(-v for v in u)) for u in unit]
    changed = {(0, *(a - b for a, b in zip(u, v))) for u in unit for v in unit if u != v}
    return [(0,) * (width + 1), *shorter, *sorted(c for c in changed if c < tuple(-v for v in c))]


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points, and the length of each word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.array([len(w) for w in words], np.int64)


def _verified(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of rows of two letter matrices are one edit apart; b's words are as long as a's or one longer."""
    n, ok = a.shape[1], np.zeros(len(i), bool)
    step = max(1, CHECKED // max(1, n))
    for s in range(0, len(i), step):
        x, y = a[i[s : s + step]], b[j[s : s + step]]
        if b.shape[1] == n:
            ok[s : s + step] = (x != y).sum(axis=1) == 1
        else:
            head, tail = x == y[:, :n], (x == y[:, 1:])[:, ::-1]
            run = [np.where(m.all(axis=1), n, m.argmin(axis=1)) for m in (head, tail)]
            ok[s : s + step] = run[0] + run[1] >= n
    return ok


def near_pairs(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs one edit apart; left words have one length, right words that or one more."""
    codes, sizes = _letters(left + right)
    symbols, symbol = np.unique(codes, return_inverse=True)
    word = np.repeat(np.arange(len(sizes)), sizes)
    counts = np.bincount(word * len(symbols) + symbol, minlength=len(sizes) * len(symbols)).reshape(len(sizes), -1).astype(np.float64)
    square, begin, n = (counts**2).sum(axis=1), np.cumsum(sizes) - sizes, int(sizes[0])
    matrix = lambda rows, width: codes[begin[rows][:, None] + np.arange(width)]
    a = matrix(np.arange(len(left)), n)
    found_i, found_j = [], []
    for width in (n, n + 1):
        rows = len(left) + np.flatnonzero(sizes[len(left) :] == width)
        if not len(rows):
            continue
        b = matrix(rows, width)
        for s in range(0, len(left), GRAM_ROWS):
            part = slice(s, min(s + GRAM_ROWS, len(left)))
            gap = square[part, None] + square[None, rows] - 2 * (counts[part] @ counts[rows].T)
            i, j = np.nonzero(gap <= 2)
            ok = _verified(a, b, i + s, j)
            found_i.append(i[ok] + s)
            found_j.append(rows[j[ok]] - len(left))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_i, found_j))


def _near(table: pa.Table) -> pa.Table:
    """Of one pair of tiles: each word's near words, the most frequent of them and its n."""
    own, same = table["own"].to_numpy(), table["same"].to_numpy()
    words, n = np.array(table["word"].to_pylist(), object), table["n"].to_numpy()
    left, right = np.flatnonzero(own), np.flatnonzero(~own)
    i, j = near_pairs(words[left].tolist(), words[right].tolist()) if len(left) and len(right) else (np.zeros(0, np.int64),) * 2
    i, j = left[i], right[j]
    twice = same[j]  # both directions meet inside a block, so each pair there counts for its left word only
    word, other = np.concatenate([i, j[~twice]]), np.concatenate([j, i[~twice]])
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(words, kind="stable")] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], word))
    word, other = word[order], other[order]
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
    near = np.diff(np.r_[first, len(word)])
    return pa.table({
        "word": pa.array(words[word[first]], pa.string()), "n_near": pa.array(near, pa.int64()),
        "form": pa.array(words[other[first]], pa.string()), "form_n": pa.array(n[other[first]], pa.int64()),
    })


def near_words(words: DataFrame, phases: Phases) -> DataFrame:
    """(word, n_near, form, form_n) of landed (word, n), for words that have a near one; form is the most frequent."""
    placed = words.select("word", "n", block_of(F.col("word")).alias("block"))
    names = ["n", *[f"c{i}" for i in range(len(CLASSES))]]
    below = [F.struct(*[(F.col(f"block.{c}") + d).alias(c) for c, d in zip(names, step)]) for step in blocks_below()]
    right = placed.select(F.posexplode(F.array(*below)).alias("step", "block"), "word", "n")
    rows = placed.select("block", "word", "n", F.lit(True).alias("own"), F.lit(False).alias("same"))
    rows = rows.union(right.select("block", "word", "n", F.lit(False).alias("own"), F.col("step") == 0))
    limit = F.greatest(F.lit(1), F.least(F.lit(TILE_WORDS), F.floor(F.lit(TILE_CHARS) / F.col("block.n"))))
    sizes = rows.groupBy("block").agg(F.count_if("own").alias("l"), F.count_if(~F.col("own")).alias("r")).where("l > 0 and r > 1")
    sizes = phases.land(sizes.select("block", F.ceil(F.col("l") / limit).cast("int").alias("l"), F.ceil(F.col("r") / limit).cast("int").alias("r")), "blocks")
    tile = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    rows = rows.join(sizes, "block")
    rows = rows.withColumn("i", F.explode(F.when(F.col("own"), F.array(tile("l"))).otherwise(every("l"))))
    rows = rows.withColumn("j", F.explode(F.when(F.col("own"), every("r")).otherwise(F.array(tile("r")))))
    found = rows.groupBy("block", "i", "j").applyInArrow(lambda t: _near(t), "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), "form"))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.n")).alias("form_n"))


def roots(forms: DataFrame, phases: Phases) -> DataFrame:
    """(word, root) of landed (word, form): where following forms ends. Each round doubles the steps; chains are short, as n grows with each."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = phases.land(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")), "roots")
        if further.where("went").isEmpty():
            return further.select("word", "root")
        now = further.select("word", "root")


def spelling_variants(docs: DataFrame, least_chars: int = 6, least_n: int = 5, ratio: int = 5, every: int = 0) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of ``docs``.

    Words are maximal runs of A-Z, a-z and U+00C0-U+00FF with A-Z lower-cased, of
    at least ``least_chars`` letters and ``least_n`` occurrences. Two are near if one
    inserted, deleted or replaced letter makes them equal. The form of a word is its
    most frequent near word (ties: smallest), if it stands ``ratio`` times as often
    or more; the root is where forms lead, or the word itself. With ``every``, that
    share of (document, run) loses one letter by the hash of both, which plants
    variants; a row with null doc_id loses none. Null and empty texts have no words,
    rows that repeat a doc_id each count, an empty table gives an empty one, and
    other columns are ignored. A text is searched whole.
    """
    phases = Phases(docs.sparkSession, "spelling")
    words = phases.land(vocabulary(docs, least_chars, least_n, every), "words")
    near = phases.land(near_words(words, phases), "near")
    phases.release()
    out = words.join(near, "word", "left")
    formed = F.col("form_n") >= ratio * F.col("n")
    out = phases.land(out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n")), "forms")
    last = roots(out.where("form is not null").select("word", "form"), phases)
    return out.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
