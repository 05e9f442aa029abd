"""Keys of similar lines: few for each line, and one in common for every pair within the edits."""

import random

from pyspark.sql import functions as F

from petrichor.llm import line_dedup


def test_similar_lines_share_an_owned_key(spark):
    rng = random.Random(3)
    letters = "abcdefgh é"
    for distance, low, high in ((1, 5, 30), (2, 7, 140), (3, 12, 80)):
        pairs = []
        for _ in range(150):
            x = "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
            y = x
            for _ in range(rng.randint(1, distance)):
                at = rng.randrange(len(y))
                y = rng.choice([y[:at] + y[at + 1 :], y[:at] + "z" + y[at:], y[:at] + "z" + y[at + 1 :]])
            pairs.append((x, y))
        lines = sorted({z for p in pairs for z in p})
        rows = line_dedup.keyed(spark.createDataFrame([(z, len(z)) for z in lines], "line string, n int"), distance, "line")
        keys: dict[str, dict[int, bool]] = {z: {} for z in lines}
        counts = dict.fromkeys(lines, 0)
        for r in rows.collect():
            keys[r.line][r.key] = keys[r.line].get(r.key, False) or r.own
            counts[r.line] += 1
        for x, y in pairs:
            assert any(own or keys[y][k] for k, own in keys[x].items() if k in keys[y]), (distance, x, y)
        # the probes of one class of lengths, twice near its lower end; before, 12 and 3 more for two edits
        assert max(counts.values()) <= 2 * sum(2 * min(i, distance - i) + 1 for i in range(distance + 1))


def test_second_signature_keeps_close_lines(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(200):
        x = "".join(rng.choice("cmfgetaoin. ,") for _ in range(rng.randint(24, 60)))
        at, to = rng.randrange(len(x)), rng.randrange(len(x))
        y = x[:at] + rng.choice("cew") + x[at + 1 :]
        rows.append((x, y[:to] + y[to + 1 :]))
    s = lambda c, letters: line_dedup.signature(F.col(c), letters)
    apart = sum(
        (line_dedup.moved(s("x", letters), s("y", letters)) for letters in (line_dedup.LETTERS, line_dedup.OTHERS)), F.lit(0)
    )
    assert not set(line_dedup.LETTERS) & set(line_dedup.OTHERS)
    assert spark.createDataFrame(rows, "x string, y string").where(apart > 4).count() == 0
