"""Many lines under one segment, and random short lines, against brute force."""

import random

import pytest

from petrichor.llm import line_dedup


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def allowed(n):
    return 2 if n >= 24 else 1 if n >= 12 else 0


def brute(rows):
    seen = sorted((i, p, x) for i, t in rows for p, x in enumerate(t.split("\n")) if x.strip())
    out = {}
    for i, t in rows:
        lines = t.split("\n")
        gone = lambda p, x: x.strip() and any(
            (j, q) < (i, p) and abs(len(x) - len(y)) <= 2 and (x == y or edits(x, y) <= allowed(min(len(x), len(y)))) for j, q, y in seen
        )
        out[i] = "\n".join(x for p, x in enumerate(lines) if not gone(p, x))
    return out


@pytest.mark.parametrize("crowd,tile", [(16, 64), (1, 3)])
def test_crowds_and_short_lines_equal_brute_force(spark, monkeypatch, crowd, tile):
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    monkeypatch.setattr(line_dedup, "TILE", tile)
    rng = random.Random(12)
    bases = ["one common beginning of a line, then ", "abcdefghijklmno", "short line 99", "ab cd", "é" * 26]

    def line():
        x = rng.choice(bases)
        if x.endswith("then "):
            x += "".join(rng.choice("abc ") for _ in range(9))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(x))
            x = rng.choice([x[:at] + x[at + 1 :], x[:at] + rng.choice("aé") + x[at:], x[:at] + rng.choice("aé") + x[at + 1 :]])
        return x

    rows = [(i, "\n".join(rng.choice(["", "  ", line(), line()]) for _ in range(6))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text for r in line_dedup.without_similar_lines(df, short_lines=True).collect()}
    assert got == brute(rows)
