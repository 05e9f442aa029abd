"""Correlations of all pairs of number columns in one pass.

Every task keeps centred co-moments of all pairs as matrices: how many rows have
both values, their means, squared deviations and co-deviation over those rows.
Such moments merge exactly (Chan, Golub and LeVeque), so tasks send them in
blocks of columns, which are merged in two levels, and no row of the table is
shuffled or unpivoted. The matrices are numpy, as 125,000 aggregate expressions
for 500 columns would neither compile nor share a pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

#: Columns of a block, and groups of tasks that are merged first.
BLOCK, FAN_IN = 64, 64
_MOMENTS = "left int, right int, group int, moments binary"
_PAIRS = "left string, right string, n long, covariance double, correlation double"


def _task(names: Sequence[str], block: int) -> tuple[Callable, Callable]:
    """(moments of a task's rows, merge of landed moments into moments or pairs).

    Both close over plain functions, so that workers need numpy and no package of ours.
    """
    size = len(names)
    cuts = [(i, min(i + block, size)) for i in range(0, size, block)]

    def of_rows(x: np.ndarray) -> np.ndarray:
        """n, mean of the left column, of the right, their squared deviations, co-deviation: six matrices."""
        with np.errstate(all="ignore"):
            there = ~np.isnan(x)
            endless = np.isinf(x)
            m = there.astype(np.float64)
            finite = np.where(there & ~endless, x, 0.0)
            n = m.T @ m
            # near the mean of its own rows, no column loses digits to a large offset
            shift = finite.sum(0) / np.maximum((there & ~endless).sum(0), 1)
            z = np.where(there & ~endless, x - shift, 0.0)
            sums, squares = z.T @ m, (z * z).T @ m
            mean = sums / np.maximum(n, 1)
            dev = squares - sums * mean
            co = z.T @ z - mean * sums.T
            bad = (endless.astype(np.float64).T @ m) > 0
            dev[bad] = np.nan
            co[bad | bad.T] = np.nan
            at = mean + shift[:, None]
            return np.stack([n, at, at.T, np.maximum(dev, 0), np.maximum(dev.T, 0), co])

    def merged(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
        if a is None:
            return b
        n = a[0] + b[0]
        part = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
        dx, dy = b[1] - a[1], b[2] - a[2]
        w = a[0] * part
        return np.stack([n, a[1] + dx * part, a[2] + dy * part, a[3] + b[3] + dx * dx * w, a[4] + b[4] + dy * dy * w, a[5] + b[5] + dx * dy * w])

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, group = None, 0
        for batch in batches:
            if batch.num_rows:
                group = batch["_group"][0].as_py()
                x = np.column_stack([batch[f"_{i}"].to_numpy(zero_copy_only=False).astype(np.float64) for i in range(size)])
                total = merged(total, of_rows(x))
        if total is None:
            total = of_rows(np.zeros((0, size)))
        pairs = [(i, j) for i in range(len(cuts)) for j in range(i, len(cuts))]
        for i, j in pairs:
            part = np.ascontiguousarray(total[:, slice(*cuts[i]), slice(*cuts[j])])
            yield pa.RecordBatch.from_pydict({"left": pa.array([i], pa.int32()), "right": pa.array([j], pa.int32()), "group": pa.array([group], pa.int32()), "moments": pa.array([part.tobytes()], pa.binary())})

    def gathered(batches: Iterator[pa.RecordBatch], keep_group: bool) -> dict[tuple[int, int, int], np.ndarray]:
        totals: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            for i, j, g, raw in zip(*(batch[c].to_pylist() for c in ("left", "right", "group", "moments"))):
                key = (i, j, g if keep_group else 0)
                shape = (6, cuts[i][1] - cuts[i][0], cuts[j][1] - cuts[j][0])
                totals[key] = merged(totals.get(key), np.frombuffer(raw, np.float64).reshape(shape))
        return totals

    def merge(final: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (i, j, g), total in gathered(batches, not final).items():
                if not final:
                    yield pa.RecordBatch.from_pydict({"left": pa.array([i], pa.int32()), "right": pa.array([j], pa.int32()), "group": pa.array([g], pa.int32()), "moments": pa.array([total.tobytes()], pa.binary())})
                    continue
                a, b = np.indices(total.shape[1:])
                a, b = a + cuts[i][0], b + cuts[j][0]
                n, _, _, dx, dy, co = total
                with np.errstate(all="ignore"):
                    covariance = np.where(n > 1, co / (n - 1), np.nan)
                    correlation = np.where((n > 1) & (dx > 0) & (dy > 0), np.clip(co / np.sqrt(dx * dy), -1, 1), np.nan)
                wanted = a < b
                numbers = lambda v: pa.array(v[wanted], mask=np.isnan(v[wanted]))
                yield pa.RecordBatch.from_pydict({
                    "left": pa.array([names[k] for k in a[wanted]], pa.string()), "right": pa.array([names[k] for k in b[wanted]], pa.string()),
                    "n": pa.array(n[wanted].astype(np.int64)), "covariance": numbers(covariance), "correlation": numbers(correlation),
                })

        return run

    return moments, merge


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None, block: int = BLOCK) -> DataFrame:
    """(left, right, n, covariance, correlation): one row per pair of columns, in the order of ``columns``.

    Pearson's correlation and the sample covariance over the ``n`` rows where neither
    value is NULL or NaN. NULL stands for a value that is not defined: fewer than two
    such rows, a column that does not vary in them (correlation only), or an infinite
    value among them. ``columns`` are all number columns unless named.
    """
    numeric = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    names = numeric if columns is None else list(columns)
    if len(set(names)) < len(names) or not set(names) <= set(numeric):
        raise ValueError(f"not different number columns: {', '.join(names)}")
    if len(names) < 2:
        return df.sparkSession.createDataFrame([], _PAIRS)
    moments, merge = _task(names, block)
    group = F.spark_partition_id() % FAN_IN
    values = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(f"_{i}") for i, c in enumerate(names)]
    tasks = df.select(group.alias("_group"), *values).mapInArrow(moments, _MOMENTS)
    tasks = tasks.repartition("left", "right", "group").mapInArrow(merge(False), _MOMENTS)
    return tasks.repartition("left", "right").mapInArrow(merge(True), _PAIRS)


def redundant_columns(matrix: DataFrame, columns: Sequence[str], limit: float = 0.8) -> list[str]:
    """Columns to prune: each that correlates by ``limit`` or more, in either direction, with an earlier one that stays.

    Only such pairs reach the driver, a few numbers for each pair of columns.
    """
    close: dict[str, set[str]] = {}
    for row in matrix.where(F.abs("correlation") >= limit).select("left", "right").collect():
        close.setdefault(row["left"], set()).add(row["right"])
        close.setdefault(row["right"], set()).add(row["left"])
    kept: set[str] = set()
    gone = []
    for c in columns:
        if close.get(c, set()) & kept:
            gone.append(c)
        else:
            kept.add(c)
    return gone
