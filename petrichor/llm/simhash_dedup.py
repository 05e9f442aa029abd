"""SimHash near-dedup by pigeonhole blocks.

A fingerprint's 64 bits are cut into ``distance + 2`` blocks. Two fingerprints
that differ in at most ``distance`` bits differ in at most that many blocks and
so agree on two of them at least: each pair of blocks is a join key of about 26
bits, and close pairs meet under one of the ten keys. Under a key they are
verified by Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .graph import connected_components
from .phases import Phases
from .tiles import forest, key_tiles
from .words import Words, chunks, joined

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch["text"]):
                words = Words(_LOWER[data], offsets)
                body, bounds = joined(words, np.ones(len(words.starts), bool))
                plain = Words(body, bounds)
                take = np.minimum(width, plain.counts)  # a short row is one shingle
                begin = np.flatnonzero(plain.within() <= (plain.counts - take)[plain.row])
                end = plain.ends[begin + take[plain.row[begin]] - 1]
                row = plain.row[begin]
                raw = body.tobytes()
                hashes = np.fromiter((digest(raw[s:e], 42) for s, e in zip(plain.starts[begin].tolist(), end.tolist())), np.uint64, len(begin))
                counts = np.bincount(row, minlength=hi - lo)
                prints = np.zeros(hi - lo, np.uint64)
                full = np.flatnonzero(counts)
                if len(full):
                    at = np.searchsorted(row, full)
                    for bit in range(64):
                        ones = np.add.reduceat((hashes >> np.uint64(bit)) & np.uint64(1), at)
                        prints[full] |= (2 * ones > counts[full]).astype(np.uint64) << np.uint64(bit)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), pa.array(prints.view(np.int64))], ["doc_id", "bits"])

    return run


def block_keys(bits, distance: int) -> list:
    """Columns: the blocks that may agree, each with its number in the high bits."""
    blocks = distance + 2
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    keys = []
    for number, (a, b) in enumerate(combinations(range(blocks), 2)):
        low, high = ((1 << edges[i + 1] - edges[i]) - 1 for i in (a, b))
        first = F.shiftrightunsigned(bits, edges[a]).bitwiseAND(low)
        second = F.shiftrightunsigned(bits, edges[b]).bitwiseAND(high)
        keys.append(F.shiftleft(F.lit(number).cast("long"), 56) + F.shiftleft(first, 28) + second)
    return keys


def _verify(distance: int):
    def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= distance

    return close


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, bits): the 64-bit SimHash of each row's shingles of ``width`` words, A-Z lower-cased.

    Fewer words make one shingle; none (or null text) gives 0.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_fingerprints(width), "doc_id long, bits long")


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, bits, component_id): linked rows share the smallest doc_id that links reach.

    Rows link when their fingerprints differ in at most ``distance`` bits. Equal
    fingerprints are one node, so copies cost nothing further. A row with null
    doc_id has its fingerprint and a null component, and links nothing. Rows
    that repeat a doc_id are each fingerprinted and count as linked. An empty
    table gives an empty one; other columns are ignored.
    """
    phases = Phases(docs.sparkSession, "simhash")
    prints = phases.land(fingerprints(docs, width), "prints")
    known = prints.where("doc_id is not null")
    nodes = phases.land(known.groupBy("bits").agg(F.min("doc_id").alias("first")), "nodes")
    keyed = nodes.select(F.explode(F.array(*block_keys(F.col("bits"), distance))).alias("key"), "bits")
    links = phases.land(key_tiles(keyed, "key", "bits", phases, forest(_verify(distance))), "edges")
    phases.release()
    # rows that repeat a doc_id tie their fingerprints together
    twice = known.groupBy("doc_id").agg(F.min("bits").alias("a"), F.max("bits").alias("b"), F.count(F.lit(1)).alias("n"))
    same = known.join(twice.where("a <> b").select("doc_id", "a"), "doc_id").select("a", F.col("bits").alias("b"))
    parts = connected_components(links.union(same), phases)
    groups = nodes.join(parts, nodes.bits == parts.node, "left").select(
        "bits", "first", F.coalesce("component", "bits").alias("part")
    )
    least = groups.groupBy("part").agg(F.min("first").alias("component_id"))
    groups = phases.land(groups.join(least, "part").select("bits", "component_id"), "groups")
    out = prints.join(groups, "bits", "left")
    return out.select("doc_id", "bits", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
