"""Comparing the rows under a key in bounded tiles, without a row for each pair."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .phases import Phases

#: Rows of a key that are compared in one piece; a larger key is cut into tiles and their pairs.
TILE_ROWS = 2048


def spanning(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Of these links, enough to connect all that they connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    kept = []
    for a, b in zip(left.tolist(), right.tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[x] = y
            kept.append((a, b))
    return kept


def forest(close: Callable[[np.ndarray, np.ndarray], np.ndarray]):
    """A task function over rows sorted by key: links between close values of one key, as a spanning forest."""

    def links(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for step in range(1, len(keys)):
            same = np.flatnonzero(keys[step:] == keys[:-step])
            if not len(same):
                break  # keys are sorted: no longer group follows
            found = same[close(values[same], values[same + step])]
            left.append(values[found])
            right.append(values[found + step])
        kept = spanning(np.concatenate(left), np.concatenate(right))
        a, b = zip(*kept) if kept else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys = np.concatenate([keys, batch["key"].to_numpy(False)])
            values = np.concatenate([values, batch["value"].to_numpy(False)])
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys == keys[-1], True))  # the last key may go on in the next batch
            if cut:
                yield links(keys[:cut], values[:cut])
                keys, values = keys[cut:], values[cut:]
        yield links(keys, values)

    return run


def key_tiles(rows: DataFrame, key: str, value: str, phases: Phases, task, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Apply ``task`` to (key, value) rows sorted by key, where no key has more than two tiles of rows.

    Counts are combined before the shuffle. Keys with a single row end there. A
    key of more than ``tile_rows`` rows is dealt into tiles by the values' hash;
    each tile goes to its pairs with all tiles of the key, under a key of their own.
    """
    counts = rows.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = phases.land(counts, "key-counts")
    met = rows.select(F.col(key).alias("key"), F.col(value).alias("value")).join(counts, "key")
    tiles = F.ceil(F.col("n") / tile_rows).cast("int")
    met = met.select("key", "value", tiles.alias("tiles"), F.expr(f"pmod(xxhash64(value, 7), ceil(n / {tile_rows}))").cast("int").alias("tile"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    met = met.withColumn("other", other).select(
        F.when(F.col("tiles") == 1, F.col("key"))
        .otherwise(F.xxhash64("key", F.least("tile", "other"), F.greatest("tile", "other")))
        .alias("key"),
        "value",
    )
    return met.repartition("key").sortWithinPartitions("key").mapInArrow(task, "u long, v long")
