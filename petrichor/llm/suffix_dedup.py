"""Suffix-array dedup over bytes: suffixes are ordered by deep-shallow sorting where two documents may agree.

Only suffixes whose first ``length`` bytes can occur twice are sorted. Each such
string holds a smallest ``gram`` (a minimizer), and equal strings hold the same
one at the same place, so the neighbouring starts that share a minimizer form a
run, and runs whose gram occurs once in all documents end there. A run's bytes
are one class with all its exact copies; if a gram has several classes, the
suffixes of their first copies are sorted to ``length`` bytes and neighbours
that agree share the smallest document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .phases import PLACE, Phases, with_tags
from .suffix_sort import deep_shallow
from .words import CODES, POWERS, chunks, mix, rolling, text_array

#: Classes of one gram that are sorted in one task; a gram with more is dealt into tiles and merged by range.
TILE_CLASSES = 4096
#: Suffixes that a task sorts at a time.
SORT_ROWS = 1 << 19


def gram_for(length: int) -> int:
    return max(1, length // 2 - 1)


def runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, first start in the row, number of starts, gram hash) of neighbouring starts with one minimizer."""
    gram = gram_for(length)
    span = length - gram + 1  # grams in a string
    full = rolling(CODES[0][data], gram)
    if len(full) < span:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    # 34 bits of the hash decide, then the leftmost place; the place is carried along
    best = (full & ~np.uint64((1 << 30) - 1)) | np.arange(len(full), dtype=np.uint64)
    width = 1
    while width * 2 <= span:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if width < span:
        best = np.minimum(best[: len(full) - span + 1], best[span - width :][: len(full) - span + 1])
    winner = (best & np.uint64((1 << 30) - 1)).astype(np.int64)
    sizes = np.diff(offsets)
    counts = np.maximum(sizes - length + 1, 0)
    row = np.repeat(np.arange(len(sizes)), counts)
    start = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = winner[start + offsets[:-1][row]]
    new = np.ones(len(row), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    return row[begin], start[begin], np.diff(np.append(begin, len(row))), full[at[begin]]


def _grams(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_numpy(False)
            for lo, hi, data, offsets in chunks(batch["text"]):
                row, _, _, h = runs(data, offsets, length)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[lo:hi][row])], ["gram", "doc_id"])

    return run


def _segments(length: int):
    """Runs whose gram is among the row's ``grams``, with 96 bits of a hash of their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags, grams = batch["doc_id"].to_numpy(False), batch["tag"].to_numpy(False), batch["grams"]
            for lo, hi, data, offsets in chunks(batch["text"]):
                row, start, n, h = runs(data, offsets, length)
                part = grams.slice(lo, hi - lo)
                known = np.repeat(np.arange(hi - lo), part.value_lengths().fill_null(0).to_numpy(False))
                salt = mix(np.arange(hi - lo, dtype=np.uint64))
                ok = np.isin(h ^ salt[row], part.flatten().to_numpy(False).view(np.uint64) ^ salt[known])
                row, start, n, h = row[ok], start[ok], n[ok], h[ok]
                digest = [_digest(data, start + offsets[:-1][row], n + length - 1, f) for f in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(digest[0].view(np.int64)),
                        pa.array((digest[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                        pa.array(h.view(np.int64)),
                        pa.array(ids[lo:hi][row]),
                        pa.array(tags[lo:hi][row] | start),
                        pa.array(n.astype(np.int32)),
                    ],
                    ["h", "g", "gram", "doc_id", "slot", "n"],
                )

    return run


def _digest(data: np.ndarray, begin: np.ndarray, size: np.ndarray, family: int) -> np.ndarray:
    """A hash of each span of bytes, from running sums."""
    up, down = POWERS[family].get(len(data))
    total = np.append(np.zeros(1, np.uint64), np.cumsum(CODES[family][data] * up))
    return mix((total[begin + size] - total[begin]) * (down[begin] if len(begin) else np.zeros(0, np.uint64)) + size.astype(np.uint64))


def _bytes_of(length: int):
    """The bytes of the row's listed ``runs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags, lists = batch["doc_id"].to_numpy(False), batch["tag"].to_numpy(False), batch["runs"]
            for lo, hi, data, offsets in chunks(batch["text"]):
                part = lists.slice(lo, hi - lo)
                row = np.repeat(np.arange(hi - lo), part.value_lengths().fill_null(0).to_numpy(False))
                flat = {f: x.to_numpy(False) for f, x in zip(("slot", "n", "gram", "tile", "tiles"), part.flatten().flatten())}
                mine = flat["slot"] & ~PLACE == tags[lo:hi][row]
                row, flat = row[mine], {f: x[mine] for f, x in flat.items()}
                size = flat["n"].astype(np.int64) + length - 1
                bounds = np.append(0, np.cumsum(size))
                at = (flat["slot"] & PLACE) + offsets[:-1][row] - bounds[:-1]
                body = data[np.arange(int(bounds[-1])) + np.repeat(at, size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat["gram"]), pa.array(flat["tile"]), pa.array(flat["tiles"]), pa.array(ids[lo:hi][row]), pa.array(flat["slot"]), pa.array(flat["n"]), text_array(body, bounds, binary=True)],
                    ["gram", "tile", "tiles", "doc_id", "slot", "n", "bytes"],
                )

    return run


def _smallest(data: np.ndarray, starts: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For each suffix the smallest document among those that agree with it."""
    order, group = deep_shallow(data, starts, length)
    least = np.zeros(len(starts), np.int64)
    if len(starts):
        head = np.searchsorted(group, np.arange(group[-1] + 1))
        least[order] = np.minimum.reduceat(docs[order], head)[group]
    return least


def _sort_tiles(length: int):
    """Rows sorted by (gram, tile): suffixes of each tile's segments. Undecided ones keep their bytes if the gram has more tiles."""

    def emit(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        batch = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        data, offsets = np.frombuffer(batch["bytes"].buffers()[2], np.uint8), np.frombuffer(batch["bytes"].buffers()[1], np.int32)
        offsets = offsets[batch["bytes"].offset : batch["bytes"].offset + len(batch) + 1].astype(np.int64)
        n = batch["n"].to_numpy(False).astype(np.int64)
        row = np.repeat(np.arange(len(batch)), n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        starts = offsets[:-1][row] + step
        docs, slots = batch["doc_id"].to_numpy(False)[row], batch["slot"].to_numpy(False)[row] + step
        gone = _smallest(data, starts, docs, length) < docs
        open_ = ~gone & (batch["tiles"].to_numpy(False)[row] > 1)
        keep = gone | open_
        raw = data.tobytes()
        suffix = [raw[s : s + length] if o else None for s, o in zip(starts[keep].tolist(), open_[keep].tolist())]
        return pa.RecordBatch.from_arrays([pa.array(docs[keep]), pa.array(slots[keep]), pa.array(suffix, pa.binary())], ["doc_id", "slot", "suffix"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            while len(batch):
                tile = np.stack([batch["gram"].to_numpy(False), batch["tile"].to_numpy(False).astype(np.int64)])
                if held and size >= SORT_ROWS:  # cut where a tile ends
                    last = np.array([[held[-1]["gram"][-1].as_py()], [held[-1]["tile"][-1].as_py()]])
                    other = np.flatnonzero((tile != last).any(0))
                    cut = int(other[0]) if len(other) else len(batch)
                    if cut:
                        held.append(batch.slice(0, cut))
                        batch = batch.slice(cut)
                    if len(other):
                        yield emit(held)
                        held, size = [], 0
                    continue
                part = batch.slice(0, 1 << 14)
                held.append(part)
                size += int(np.sum(part["n"].to_numpy(False)))
                batch = batch.slice(len(part))
        if held:
            yield emit(held)

    return run


def _merge(length: int):
    """One range of the global suffix order: sort it, and name the suffixes that a smaller document has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        batch = pa.Table.from_batches(parts).combine_chunks()
        if not len(batch):
            return
        data = np.frombuffer(b"".join(batch["suffix"].to_pylist()), np.uint8)
        docs = batch["doc_id"].to_numpy()
        gone = _smallest(data, np.arange(len(docs)) * length, docs, length) < docs
        yield pa.RecordBatch.from_arrays([pa.array(docs[gone]), pa.array(batch["slot"].to_numpy()[gone])], ["doc_id", "slot"])

    return run


def _strip(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags, spans = batch["tag"].to_numpy(False), batch["spans"]
            for lo, hi, data, offsets in chunks(batch["text"]):
                part = spans.slice(lo, hi - lo)
                row = np.repeat(np.arange(hi - lo), part.value_lengths().fill_null(0).to_numpy(False))
                flat = part.flatten()
                slot, n = flat.field(0).to_numpy(False).astype(np.int64), flat.field(1).to_numpy(False).astype(np.int64)
                mine = slot & ~PLACE == tags[lo:hi][row]
                row, slot, n = row[mine], slot[mine] & PLACE, n[mine]
                begin = slot + offsets[:-1][row]
                change = np.bincount(begin, minlength=len(data) + 1) - np.bincount(begin + n + length - 1, minlength=len(data) + 1)
                gone = np.cumsum(change)[: len(data)] > 0
                sizes = np.diff(offsets)
                of = np.repeat(np.arange(hi - lo), sizes)
                opens = gone.copy()
                opens[1:] &= ~gone[:-1] | (of[1:] != of[:-1])
                removed = np.bincount(of[gone], minlength=hi - lo)
                bounds = np.append(0, np.cumsum(sizes - removed))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, hi - lo), pa.array(sizes), pa.array(removed), pa.array(np.bincount(of[opens], minlength=hi - lo)), text_array(data[~gone], bounds, binary=True)],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return run


def remove_repeated_bytes(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): each row's UTF-8 bytes without repeated strings.

    A byte goes if a string of ``length`` bytes that covers it also starts in a
    row with a smaller doc_id; strings never cross rows and are judged on the
    input. ``kept`` (binary) is what is left. Null text counts as empty. A row
    with null doc_id keeps all its bytes and takes none from others. Rows that
    repeat a doc_id don't affect each other, and each gets its own result row.
    An empty table gives an empty one; other columns are ignored.
    """
    phases = Phases(docs.sparkSession, "suffix")
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = with_tags(rows, phases)
    known = rows.where("doc_id is not null")
    grams = known.mapInArrow(_grams(length), "gram long, doc_id long")
    shared = phases.land(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "shared")
    phases.release()
    near = phases.land(grams.join(shared, "gram").groupBy("doc_id").agg(F.collect_list("gram").alias("grams")), "near")
    phases.drop(shared)
    found = known.join(near, "doc_id").mapInArrow(
        _segments(length), "h long, g int, gram long, doc_id long, slot long, n int"
    )
    segments = phases.land(found, "segments")
    phases.drop(near)
    classes = segments.groupBy("h", "g", "gram").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    classes = phases.land(classes, "classes")
    phases.release()
    copies = segments.drop("gram").join(classes.where("first < last").select("h", "g", "first"), ["h", "g"])
    whole = phases.land(copies.where("doc_id > first").select("doc_id", "slot", "n"), "copies")
    phases.release()
    # suffixes of each class's first document, where a gram has several classes
    several = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    several = several.select("gram", F.ceil(F.col("k") / TILE_CLASSES).cast("int").alias("tiles"))
    heads = phases.land(classes.join(several, "gram").select("h", "g", "first", "tiles"), "contested")
    heads = segments.join(heads, ["h", "g"]).where("doc_id = first")
    each = F.struct("slot", "n", "gram", F.expr("pmod(h, tiles)").cast("int").alias("tile"), "tiles")
    heads = phases.land(heads.groupBy("doc_id").agg(F.collect_list(each).alias("runs")), "heads")
    phases.drop(segments, classes)
    body = known.join(heads, "doc_id").mapInArrow(
        _bytes_of(length), "gram long, tile int, tiles int, doc_id long, slot long, n int, bytes binary"
    )
    sorted_ = body.repartition("gram", "tile").sortWithinPartitions("gram", "tile")
    sorted_ = phases.land(sorted_.mapInArrow(_sort_tiles(length), "doc_id long, slot long, suffix binary"), "sorted")
    phases.drop(heads)
    undecided = sorted_.where("suffix is not null")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), undecided.count() // SORT_ROWS + 1)
    merged = undecided.repartitionByRange(ranges, "suffix").mapInArrow(_merge(length), "doc_id long, slot long")
    single = sorted_.where("suffix is null").select("doc_id", "slot").union(merged).select("*", F.lit(1).alias("n"))
    spans = whole.union(single).groupBy("doc_id").agg(F.collect_list(F.struct("slot", "n")).alias("spans"))
    spans = phases.land(spans, "removed")
    phases.drop(whole, sorted_)
    return rows.join(spans, "doc_id", "left").mapInArrow(
        _strip(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
