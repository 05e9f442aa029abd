"""Substring dedup over words: difference-cover anchors, then extension to whole windows.

A cover of period ``p`` is a set of residues such that any two places agree on
one of them after a common shift below ``p``. Hashing the ``window - p + 1``
words that begin at cover places only (6 of 31 for 50 words) therefore leaves
at least one shared, aligned anchor inside any two equal windows. Anchors that
occur once end there; around the others every window that holds the anchor is
hashed in full (96 bits), and windows that also start in a smaller document
are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .phases import PLACE, Phases, with_tags
from .words import Words, chunks, covered, joined, rolling, text_array

#: Perfect difference sets by period (fixed values).
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The largest period that leaves anchors of a third of the window or more."""
    period = max(p for p in COVERS if p <= max(1, 2 * window // 3))
    return period, COVERS[period]


def _anchors(window: int):
    period, cover = cover_for(window)
    width = window - period + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch["doc_id"].to_numpy(False), batch["tag"].to_numpy(False)
            for lo, hi, data, offsets in chunks(batch["text"]):
                words = Words(data, offsets)
                h = rolling(words.hashes(), width)
                place = words.within()[: len(h)]
                row = words.row[: len(h)]
                ok = np.isin(place % period, cover) & (place + width <= words.counts[row]) & (words.counts[row] >= window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[ok].view(np.int64)), pa.array(ids[lo:hi][row[ok]]), pa.array(tags[lo:hi][row[ok]] | place[ok])],
                    ["anchor", "doc_id", "slot"],
                )

    return run


def _windows(window: int):
    period, _ = cover_for(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch["doc_id"].to_numpy(False), batch["tag"].to_numpy(False)
            slots = batch["slots"]
            for lo, hi, data, offsets in chunks(batch["text"]):
                words = Words(data, offsets)
                near, row = _places(slots, lo, hi, tags, words)
                low = np.maximum(near - (period - 1), 0)
                size = len(words.starts) + 1
                change = np.bincount(low + words.first[row], minlength=size)[:size] - np.bincount(near + 1 + words.first[row], minlength=size)[:size]
                h, g = rolling(words.hashes(0), window, 0), rolling(words.hashes(1), window, 1)
                place, row = words.within()[: len(h)], words.row[: len(h)]
                ok = (np.cumsum(change)[: len(h)] > 0) & (place + window <= words.counts[row])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h[ok].view(np.int64)),
                        pa.array((g[ok] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                        pa.array(ids[lo:hi][row[ok]]),
                        pa.array(tags[lo:hi][row[ok]] | place[ok]),
                    ],
                    ["h", "g", "doc_id", "slot"],
                )

    return run


def _places(slots: pa.Array, lo: int, hi: int, tags: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word places that belong to this chunk's rows by their tags, and those rows (from 0)."""
    part = slots.slice(lo, hi - lo)
    counts = part.value_lengths().fill_null(0).to_numpy(False)
    row = np.repeat(np.arange(hi - lo), counts)
    slot = part.flatten().to_numpy(False).astype(np.int64)
    mine = slot & ~PLACE == tags[lo:hi][row]
    return (slot & PLACE)[mine], row[mine]


def _strip(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags, slots = batch["tag"].to_numpy(False), batch["slots"]
            for lo, hi, data, offsets in chunks(batch["text"]):
                words = Words(data, offsets)
                place, row = _places(slots, lo, hi, tags, words)
                gone = covered(place + words.first[row], window, len(words.starts))
                removed = np.bincount(words.row[gone], minlength=hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, hi - lo), pa.array(words.counts), pa.array(removed), text_array(*joined(words, ~gone))],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    return run


def remove_repeated_words(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each row's words without those of repeated windows.

    A window is ``window`` consecutive words of one row, judged on the input; it
    goes if its words also start in a row with a smaller doc_id. ``kept`` joins
    the other words by one space. Null text counts as empty. A row with null
    doc_id keeps all its words and takes none from others. Rows that repeat a
    doc_id don't affect each other, and each gets its own result row. An empty
    table gives an empty one; other columns are ignored.
    """
    phases = Phases(docs.sparkSession, "substring")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = with_tags(rows, phases)
    known = rows.where("doc_id is not null")
    anchors = phases.land(known.mapInArrow(_anchors(window), "anchor long, doc_id long, slot long"), "anchors")
    shared = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    shared = phases.land(shared, "shared")
    phases.release()
    near = anchors.join(shared, "anchor").groupBy("doc_id").agg(F.collect_list("slot").alias("slots"))
    near = phases.land(near, "near")
    phases.drop(anchors, shared)
    spans = known.join(near, "doc_id").mapInArrow(_windows(window), "h long, g int, doc_id long, slot long")
    spans = phases.land(spans, "windows")
    phases.drop(near)
    first = spans.groupBy("h", "g").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = phases.land(first.where("first < last").select("h", "g", "first"), "repeated")
    phases.release()
    gone = spans.join(first, ["h", "g"]).where("doc_id > first")
    gone = phases.land(gone.groupBy("doc_id").agg(F.collect_list("slot").alias("slots")), "removed")
    phases.drop(spans, first)
    return rows.join(gone, "doc_id", "left").mapInArrow(
        _strip(window), "doc_id long, n_words long, n_removed long, kept string"
    )
