"""Line dedup by a segment-partition edit join, in built-in functions only.

Distinct lines of at least ``min_chars`` characters have ``distance + 1``
segments whose size follows from the line's class of lengths: the first half is
placed from the start of the line, the others from its end. Two lines within
``distance`` edits share one segment unchanged, moved by as many places as
segments lie between it and that end at most, so a line is indexed by its
segments (class, number, segment) and probes with its own substrings at those
places, and with those of the class below if a line up to ``distance`` shorter
may lie there. Keys are counted first, and only those that several lines have
are joined. Lines that meet are verified by the banded bit-parallel edit
distance, unless their letter counts already rule them out.

All that is asked of a line is whether a similar one stands earlier. Under a
segment that more than ``CROWD`` rows have, each line is compared with the
earliest of them; those that this doesn't settle are compared with the others in
arrays of ``TILE`` lines, each giving one answer. So rows grow with the lines and
not with their pairs, and no pair is left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .phases import Phases, computed_once

#: Rows under a segment above which they aren't paired one by one, and lines of an array.
CROWD, TILE = 16, 64


def least_length(n: Column, distance: int) -> Column:
    """The least length of the class of ``n``; ``distance`` less lies in the same class or in the next one below."""
    step = max(4, distance)
    lower = F.when(n < 8 * step, n - n % step).otherwise(n - n % (2 * step))
    return F.greatest(lower, F.lit(distance + 1))


def keyed(lines: DataFrame, distance: int, *keep: str) -> DataFrame:
    """``key``, ``own`` and ``keep`` of ``lines`` (line, n, ...): ``own`` marks the line's segments, other rows only probe.

    Lines within ``distance`` edits have a key in common that one of them owns. One
    short expression over (class below, segment, shift), not one for each: Spark compiles it whole.
    """
    room = [min(i, distance - i) for i in range(distance + 1)]
    wanted = [(below, i, shift) for below in (False, True) for i, r in enumerate(room) for shift in range(-r, r + 1)]
    place = lambda w: F.struct(*[F.lit(v).alias(name) for v, name in zip(w, ("below", "i", "shift"))])
    near, all_ = (F.array(*[place(w) for w in wanted if not w[0] or both]) for both in (False, True))
    at, under = least_length(F.col("n"), distance), least_length(F.col("n") - distance, distance)
    rows = lines.select("*", at.alias("at"), under.alias("under")).select("*", F.inline(F.when(F.col("at") == F.col("under"), near).otherwise(all_)))
    least = F.when(F.col("below"), F.col("under")).otherwise(F.col("at"))
    size = F.floor(least / (distance + 1)).cast("int")
    first = F.when(F.col("i") <= distance // 2, F.col("i") * size).otherwise(F.col("n") - (distance + 1 - F.col("i")) * size)
    key = F.xxhash64(least, "i", F.substring(F.col("line"), first + F.col("shift") + 1, size))
    return rows.select(key.alias("key"), (~F.col("below") & (F.col("shift") == 0)).alias("own"), *keep)


#: Bits of the word that holds a column of differences; the band uses the highest 2 * distance + 1.
_WORD = 32
_MASK = (1 << _WORD) - 1


def edit_distance(a: Column, b: Column, distance: int) -> Column:
    """Edits between two character arrays, right wherever it is at most ``distance``, else more than that.

    Lengths must differ by ``distance`` at most, and ``a`` must be longer than it.
    One word holds the vertical differences of a column (Myers), and the word
    moves down one place with each character of ``b`` (Hyyrö's banded form): its
    highest bit stands for the place ``distance`` below the diagonal, and matches
    outside the band count as none, which no path of ``distance`` edits needs. The
    score follows that lower edge until it meets the end of ``a``, then its last row.
    """
    n = F.size(a)
    long = lambda x: F.lit(x).cast("long")
    inverse = lambda x: x.bitwiseXOR(long(_MASK))
    start = F.struct(
        long((_MASK << (_WORD - distance - 1)) & _MASK).alias("vp"),
        long(0).alias("vn"),
        F.lit(distance).alias("score"),
        F.lit(0).alias("j"),
    )

    def step(s: Column, c: Column) -> Column:
        hits = [
            F.when(F.coalesce(F.get(a, s["j"] + distance - k) == c, F.lit(False)), long(1 << (_WORD - 1 - k))).otherwise(long(0))
            for k in range(2 * distance + 1)
        ]
        eq = hits[0]
        for h in hits[1:]:
            eq = eq.bitwiseOR(h)
        return F.struct(eq.alias("eq"), s["vp"].alias("vp"), s["vn"].alias("vn"), s["score"].alias("score"), s["j"].alias("j"))

    def named(x: Column, f) -> Column:
        """Apply ``f`` to a value once computed, not once for each mention."""
        return F.get(F.transform(F.array(x), f), 0)

    def column(s: Column) -> Column:
        eq, vp, vn = s["eq"], s["vp"], s["vn"]
        d0 = (eq.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(eq).bitwiseOR(vn).bitwiseAND(long(_MASK))
        return named(d0, lambda d: named(
            F.struct(vn.bitwiseOR(inverse(d.bitwiseOR(vp))).alias("hp"), d.bitwiseAND(vp).alias("hn"), F.shiftright(d, 1).alias("down"), d.alias("d")),
            lambda h: F.struct(
                h["hn"].bitwiseOR(inverse(h["down"].bitwiseOR(h["hp"]))).alias("vp"),
                h["down"].bitwiseAND(h["hp"]).alias("vn"),
                (s["score"] + _change(h, s["j"], n, distance)).alias("score"),
                (s["j"] + 1).alias("j"),
            ),
        ))

    return F.aggregate(b, start, lambda s, c: named(step(s, c), column), lambda s: s["score"])


def _change(h: Column, j: Column, n: Column, distance: int) -> Column:
    """What one more character adds to the score: at the band's lower edge, or on the last row of ``a``."""
    edge = F.when(h["d"].bitwiseAND(F.lit(1 << (_WORD - 1)).cast("long")) == 0, 1).otherwise(0)
    bit = lambda x: F.call_function("shiftright", x, n + (_WORD - 2 - distance) - j).bitwiseAND(F.lit(1).cast("long"))
    return F.when(j < n - distance, edge).otherwise((bit(h["hp"]) - bit(h["hn"])).cast("int"))


#: Characters whose counts, modulo 32, make up a line's signature, and those of a second one.
LETTERS, OTHERS = "etaoinrshdlu", "cmfgpybwvk.,"


def signature(line: Column, letters: str = LETTERS) -> Column:
    counts = [F.length(line) - F.length(F.replace(line, F.lit(c), F.lit(""))) for c in letters]
    out = F.lit(0).cast("long")
    for k, n in enumerate(counts):
        out = out.bitwiseOR(F.shiftleft(n.cast("long").bitwiseAND(F.lit(31).cast("long")), 5 * k))
    return out


def moved(a: Column, b: Column) -> Column:
    """How far letter counts of two signatures are apart in sum, at least."""
    out = F.lit(0)
    for k in range(len(LETTERS)):
        apart = (F.shiftright(a, 5 * k) - F.shiftright(b, 5 * k)).bitwiseAND(F.lit(31).cast("long"))
        out = out + F.least(apart, F.lit(32).cast("long") - apart)
    return out


def may_be_close(a: Column, b: Column, distance: int) -> Column:
    """False only for signatures of lines more than ``distance`` edits apart: an edit moves letter counts by two at most."""
    return moved(a, b) <= 2 * distance


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, the hash of the text, and the lines, of rows that have both."""
    rows = docs.where("doc_id is not null and text is not null")
    return rows.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("row"), F.split("text", "\n", -1).alias("lines"))


def _exploded(docs: DataFrame, min_chars: int, short_lines: bool) -> DataFrame:
    lines = _identified(docs).select("doc_id", "row", F.posexplode("lines").alias("place", "line"))
    long = F.col("line").rlike(r"\S") if short_lines else F.length("line") >= min_chars
    h, g = F.when(long, F.xxhash64("line")), F.when(long, F.xxhash64(F.lit(3), "line"))
    return lines.select("doc_id", "row", "place", "line", h.alias("h"), g.alias("g"))


def _verified(pairs: DataFrame, lines: DataFrame, distance: int, phases: Phases, name: str) -> DataFrame:
    """(h): of landed pairs (a, b) within ``distance`` edits, the line that first stands later.

    Letter counts are made for these pairs alone, and rule most of them out before any alignment.
    """
    asked = pairs.select(F.explode(F.array("a", "b")).alias("asked"), "a", "b")
    texts = lines.select(F.col("h").alias("asked"), F.struct("line", "first").alias("text"))
    texts = asked.hint("merge").join(texts, "asked").groupBy("a", "b").agg(
        F.max_by("text", F.col("asked") == F.col("a")).alias("x"), F.max_by("text", F.col("asked") == F.col("b")).alias("y")
    )
    marked = computed_once(texts.withColumns({"s": signature(F.col("x.line")), "t": signature(F.col("y.line"))}), "s")
    marked = marked.where(may_be_close(F.col("s"), F.col("t"), distance) & (F.col("x.first") != F.col("y.first")))
    # the second signature is made for those that pass the first, and both count together
    marked = computed_once(marked.withColumns({"s2": signature(F.col("x.line"), OTHERS), "t2": signature(F.col("y.line"), OTHERS)}), "s2")
    marked = marked.where(moved(F.col("s"), F.col("t")) + moved(F.col("s2"), F.col("t2")) <= 2 * distance)
    later = F.when(F.col("x.first") > F.col("y.first"), F.col("a")).otherwise(F.col("b"))
    chars = computed_once(marked.select(later.alias("h"), F.split("x.line", "").alias("x"), F.split("y.line", "").alias("y")), "x")
    close = chars.where(F.abs(F.size("x") - F.size("y")) <= distance)
    close = close.withColumn("edits", edit_distance(F.col("x"), F.col("y"), distance)).where(F.col("edits") <= distance)
    return phases.land(close.select("h").distinct(), name)


def _pairs(met: DataFrame, distance: int) -> DataFrame:
    """Of rows (a, na, b, nb) the pairs of different lines whose lengths allow for ``distance`` edits."""
    met = met.where((F.col("a") != F.col("b")) & (F.abs(F.col("na") - F.col("nb")) <= distance))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def similar_earlier(lines: DataFrame, distance: int, phases: Phases) -> DataFrame:
    """(h): the ``lines`` (h, line, n, first) with an earlier one within ``distance`` edits; first says where a line stands first."""
    counts = keyed(lines, distance).groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.count_if("own").alias("owners"))
    shared = phases.land(counts.where("k > 1 and owners > 0").select("key", "k"), "shared-keys")
    phases.release()
    met = phases.land(keyed(lines, distance, "h", "n").join(shared, "key"), "met")
    phases.drop(shared)
    few, hot = met.where(F.col("k") <= CROWD), met.where(F.col("k") > CROWD)
    named = lambda rows, h, n: rows.select("key", F.col("h").alias(h), F.col("n").alias(n))
    pairs = _pairs(named(few.where("own"), "a", "na").join(named(few, "b", "nb"), "key"), distance)
    crowded = not hot.isEmpty()
    if crowded:
        firsts = hot.select("key", "h", "n").join(lines.select("h", "first"), "h")
        least = firsts.groupBy("key").agg(F.min(F.struct("first", "h", "n")).alias("least"))
        least = phases.land(least.select("key", F.col("least.h").alias("a"), F.col("least.n").alias("na")), "hot-keys")
        pairs = pairs.union(_pairs(named(hot, "b", "nb").join(least, "key"), distance))
    pairs = phases.land(pairs.distinct(), "candidates")
    phases.release()
    found = _verified(pairs, lines, distance, phases, "similar")
    phases.drop(pairs)
    if not crowded:
        phases.drop(met)
        return found
    # what the earliest line of a key doesn't settle is compared with all others; nothing under the key stands before itself
    open_ = hot.join(found, "h", "left_anti").join(least.withColumnRenamed("a", "h"), ["key", "h"], "left_anti")
    open_ = phases.land(open_.select("key", "h", "own").distinct(), "open")
    crowd = phases.land(hot.join(open_.select("key").distinct(), "key", "left_semi").select("key", "h", "own").distinct(), "crowd")
    texts = lines.join(crowd.select("h").distinct(), "h", "left_semi").select("h", "line", "n", "first", signature(F.col("line")).alias("s"))
    texts = phases.land(texts, "crowd-lines")
    phases.drop(met, least)
    rest = [found]
    for asks, holds in (("true", "own"), ("own", "not own")):
        # those not settled yet, against the lines that own their key, then those that own it against the others
        asked, held = open_.where(asks).select("key", "h").distinct().join(texts, "h"), crowd.where(holds).join(texts, "h")
        sizes = crowd.where(holds).groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
        sizes = phases.land(sizes, "tiles")
        held = held.join(sizes, "key").withColumn("tile", F.pmod(F.xxhash64("h", F.lit(5)), F.col("tiles")).cast("int"))
        held = held.groupBy("key", "tile").agg(F.collect_list(F.struct("h", "line", "n", "s", "first")).alias("held"))
        asked = asked.join(sizes, "key").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        asked = asked.withColumn("chars", F.split("line", ""))
        both = computed_once(asked.join(held, ["key", "tile"]).select("h", "n", "s", "first", "chars", "held"), "chars")
        rest.append(phases.land(both.where(F.exists("held", lambda x: _like(x, distance))).select("h").distinct(), "tile-similar"))
    return reduce(DataFrame.union, rest).distinct()


def _like(x: Column, distance: int) -> Column:
    """Whether line ``x`` of an array stands before the row's line and is similar; what costs little comes first."""
    sized = F.abs(x["n"] - F.col("n")) <= distance
    cheap = sized & (x["h"] != F.col("h")) & (x["first"] < F.col("first")) & may_be_close(x["s"], F.col("s"), distance)
    return F.when(cheap, edit_distance(F.col("chars"), F.split(x["line"], ""), distance) <= distance).otherwise(False)


def scaled_earlier(lines: DataFrame, distance: int, min_chars: int, phases: Phases) -> list[DataFrame]:
    """Similar lines of ``min_chars`` or more, then, for each smaller number of edits, of those that are long enough for it only."""
    n = F.col("n")
    found = [similar_earlier(lines.where(n >= min_chars), distance, phases)]
    for edits in range(distance - 1, 0, -1):
        low, high = -(-min_chars * edits // distance), -(-min_chars * (edits + 1) // distance) - 1
        # the shorter line of a pair decides, so the longer one may have the length of the next class
        found.append(similar_earlier(phases.land(lines.where(n.between(low, high + edits)), "shorter"), edits, phases))
    return found


def without_similar_lines(docs: DataFrame, distance: int = 2, min_chars: int = 24, short_lines: bool = False) -> DataFrame:
    """``docs`` with earlier-seen lines taken out of ``text``, and ``__l_lines`` and ``__l_removed`` (long) added.

    Lines are what lies between line feeds. A line of at least ``min_chars``
    characters goes if a line within ``distance`` edits stands earlier: in a row
    with a smaller doc_id, or further up in its own. Judged on the input, so a
    line may go for one that goes itself. Shorter lines stay, as do rows with null
    doc_id; null text stays null with 0 lines. With ``short_lines``, shorter lines
    go too if an equal line stands earlier, or one within fewer edits in proportion
    to the shorter one's length (one edit from half of ``min_chars`` on, if
    ``distance`` is two); lines of white space only stay. Rows that repeat a doc_id are told
    apart by their text; full repeats are treated alike. An empty table gives an
    empty one, and other columns pass through. ``min_chars`` must be more than
    ``distance`` times two, so that every segment has a character.
    """
    if min_chars <= 2 * distance:
        raise ValueError("min_chars must be more than distance times two")
    phases = Phases(docs.sparkSession, "lines")
    found = _exploded(docs, min_chars, short_lines)
    first = found.where("h is not null").groupBy("h", "g").agg(F.min(F.struct("doc_id", "place", "line")).alias("first"), F.count(F.lit(1)).alias("times"))
    line = F.col("first.line")
    distinct = first.select("h", "g", "times", F.struct("first.doc_id", "first.place").alias("first"), line.alias("line"), F.length(line).alias("n"))
    distinct = phases.land(distinct, "distinct")
    phases.release()
    lines = distinct.drop("g", "times")
    if short_lines:
        similar = reduce(DataFrame.union, scaled_earlier(lines, distance, min_chars, phases)).distinct()
    else:
        similar = similar_earlier(lines, distance, phases)
    # a line that stands once goes only if a similar one stands earlier
    earliest = distinct.select("h", "g", "first", "times").join(similar.withColumn("similar", F.lit(True)), "h", "left").where("times > 1 or similar")
    earliest = phases.land(earliest.select("h", "g", F.col("first").alias("seen"), F.coalesce("similar", F.lit(False)).alias("similar")), "earliest")
    phases.drop(distinct)
    flags = found.drop("line").join(earliest, ["h", "g"]).where(F.col("similar") | (F.col("seen") < F.struct("doc_id", "place")))
    flags = flags.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("place")).alias("places"))
    before = lambda k: F.coalesce(F.get("places", k - 1), F.lit(-1))
    # one mark a line, up to the last that goes
    marks = F.array_join(F.transform("places", lambda p, k: F.concat(F.repeat(F.lit("0"), p - before(k) - 1), F.lit("1"))), "")
    marks = F.transform(F.split(marks, ""), lambda x: x == "1")
    flags = flags.select("doc_id", "row", marks.alias("__l_flags"), F.size("places").cast("long").alias("__l_removed"))
    flags = phases.land(flags, "flags")
    phases.drop(earliest)
    flags = flags.select(F.col("doc_id").alias("__l_id"), F.col("row").alias("__l_row"), "__l_flags", F.col("__l_removed").alias("__l_out")).hint("merge")
    out = docs.withColumn("__l_row_", F.xxhash64("text")).join(
        flags, (F.col("doc_id").cast("long") == F.col("__l_id")) & (F.col("__l_row_") == F.col("__l_row")), "left"
    )
    lines, marks = F.split("text", "\n", -1), F.col("__l_flags")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.coalesce(F.get(marks, i), F.lit(False))), "\n")
    out = out.withColumn("__l_text", F.when(marks.isNull(), F.col("text")).otherwise(kept))
    names = [F.col("__l_text").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    counts = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    return out.select(*names, counts.alias("__l_lines"), F.coalesce("__l_out", F.lit(0)).cast("long").alias("__l_removed"))
