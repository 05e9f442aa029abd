"""Embedding near-dedup by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned to their principal axes, which
keeps cosines and moves most of each vector into its leading dimensions. Two
vectors of cosine ``t`` or more are at most sqrt(2 - 2t) apart, so cells of that
width on the two leading axes only meet their neighbours. Cells are cut into
tiles, and two tiles are compared by adding up products of leading dimensions
first; what is left of a product is bounded by the vectors' suffix norms, and
a pair stops when sum and bound cannot reach the threshold. Pairs that go all
the way are decided on the vectors as given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .graph import connected_components
from .phases import Phases
from .tiles import spanning

TILE_ROWS = 1024
#: Leading dimensions after which pairs are given up on, as shares of all.
STEPS = (0.125, 0.25, 0.5, 1.0)
#: Products and norms of a tile pair are wrong by far less than this.
SLACK = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of products of unit vectors, one matrix for each length that a task meets."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        sizes = batch["embedding"].value_lengths().to_numpy(False)
        for d in np.unique(sizes).tolist():
            x = _matrix(batch["embedding"].filter(pa.array(sizes == d)))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            sums[d] = sums.get(d, 0) + x.T @ x
    if sums:
        keys = [(d, i) for d in sums for i in range(d)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in keys], pa.int32()), pa.array([i for _, i in keys], pa.int32()), pa.array([sums[d][i] for d, i in keys], pa.list_(pa.float64()))],
            ["d", "i", "products"],
        )


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length the axes as columns, by falling second moment. Only d x d sums reach the driver."""
    parts = vectors.select("embedding").mapInArrow(_moments, "d int, i int, products array<double>")
    sums = parts.select("d", "i", F.posexplode("products").alias("j", "p")).groupBy("d", "i", "j").agg(F.sum("p").alias("p"))
    axes: dict[int, np.ndarray] = {}
    for r in sums.collect():
        axes.setdefault(r["d"], np.zeros((r["d"], r["d"])))[r["i"], r["j"]] = r["p"]
    return {d: np.linalg.eigh(m + m.T)[1][:, ::-1].copy() for d, m in axes.items()}


def _cells(axes: dict[int, np.ndarray], width: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["embedding"].value_lengths().to_numpy(False)
            cell = np.zeros((len(batch), 2), np.int32)
            for d in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == d)
                x = _matrix(batch["embedding"].take(pa.array(mine)))
                y = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ axes[d][:, :2]
                cell[mine, : y.shape[1]] = np.floor(y / width)
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in batch.schema.names] + [pa.array(sizes, pa.int32()), pa.array(cell[:, 0]), pa.array(cell[:, 1])],
                [*batch.schema.names, "d", "c0", "c1"],
            )

    return run


def close_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of two tiles whose cosine is at least ``threshold``; of one tile with itself, i < j."""
    na, nb = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
    ya, yb = (a / na[:, None]) @ axes, (b / nb[:, None]) @ axes
    d = a.shape[1]
    cuts = sorted({max(1, round(d * s)) for s in STEPS})
    rest = [(np.sqrt((ya[:, c:] ** 2).sum(1)), np.sqrt((yb[:, c:] ** 2).sum(1))) for c in cuts]
    sums = ya[:, : cuts[0]] @ yb[:, : cuts[0]].T
    i, j = np.nonzero(sums + np.outer(*rest[0]) >= threshold - SLACK)
    if same:
        i, j = i[i < j], j[i < j]
    part = sums[i, j]
    for (lo, hi), (ra, rb) in zip(zip(cuts, cuts[1:]), rest[1:]):
        part = part + np.einsum("ij,ij->i", ya[i, lo:hi], yb[j, lo:hi])
        live = part + ra[i] * rb[j] >= threshold - SLACK
        i, j, part = i[live], j[live], part[live]
    exact = np.einsum("ij,ij->i", a[i], b[j]) / (na[i] * nb[j])
    return i[exact >= threshold], j[exact >= threshold]


def _compare(axes: dict[int, np.ndarray], threshold: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = {"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())}
        if not len(left) or not len(right):
            return pa.table(empty)
        same = left["same"][0].as_py()
        a, b = (_matrix(t["embedding"].combine_chunks()) for t in (left, right))
        ids, other = left["node"].to_numpy(), right["node"].to_numpy()
        if same:
            order = np.argsort(ids)
            a, ids, copies = a[order], ids[order], left["copies"].to_numpy()[order]
            b, other, more = a, ids, copies
        else:
            copies, more = left["copies"].to_numpy(), right["copies"].to_numpy()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for lo in range(0, len(a), 512):
            i, j = close_pairs(a[lo : lo + 512], b, axes[a.shape[1]], threshold, False)
            if same:
                i, j = i[i + lo < j], j[i + lo < j]
            found.append((i + lo, j))
        i, j = (np.concatenate(x) for x in zip(*found))
        node = np.concatenate([ids[i], other[j]])
        links = np.concatenate([more[j], copies[i]])
        nodes, at = np.unique(node, return_inverse=True)
        tree = spanning(ids[i], other[j])
        n = len(nodes) + len(tree)
        fill = lambda x, before: pa.array(np.concatenate([np.full(before, -1), x, np.full(n - before - len(x), -1)]).astype(np.int64))
        total = np.bincount(at, links, len(nodes)) if len(nodes) else np.zeros(0)
        u, v = (np.array(x, np.int64) for x in zip(*tree)) if tree else (np.zeros(0), np.zeros(0))
        return pa.table({"node": fill(nodes, 0), "links": fill(total, 0), "u": fill(u, len(nodes)), "v": fill(v, len(nodes))})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label).

    Two vectors link when their labels are equal and not null and their cosine in
    double precision is at least ``threshold`` (above 0). A null vector, one with a
    null or non-finite part, an empty or zero one links with nothing, and neither
    do vectors of different length. n_links counts the other rows linked directly;
    equal vectors of a label are one node, so copies are never paired. Rows that
    repeat a vec_id count as rows and share a component only through links. A row
    with null vec_id has no links and a null component. An empty table gives an
    empty one; other columns are ignored.
    """
    spark = vectors.sparkSession
    phases = Phases(spark, "embedding")
    value = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), value.alias("embedding"), F.col("label").cast("string").alias("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    length = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & finite
    rows = rows.withColumn("usable", F.coalesce(F.when(usable, length > 0), F.lit(False)))
    rows = rows.withColumn("h", F.when(F.col("usable"), F.xxhash64("label", "embedding")))
    rows = rows.withColumn("g", F.when(F.col("usable"), F.xxhash64(F.lit(5), "embedding", "label")))
    rows = phases.land(rows, "rows")
    good = rows.where("usable")
    groups = good.groupBy("h", "g").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    groups = phases.land(groups, "groups")
    nodes = good.join(groups, ["h", "g"]).where("vec_id = node").dropDuplicates(["h", "g"])
    nodes = nodes.select("node", "copies", "label", "embedding")
    axes = principal_axes(nodes)
    width = float(np.sqrt(2 - 2 * threshold)) * (1 + 1e-9) + 1e-9
    placed = nodes.mapInArrow(_cells(axes, width), "node long, copies long, label string, embedding array<double>, d int, c0 int, c1 int")
    placed = phases.land(placed, "placed")
    cell = ["label", "d", "c0", "c1"]
    tiles = placed.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).cast("int").alias("tiles"))
    tiles = phases.land(tiles, "tiles")
    # each cell with itself and with half of its neighbours; a tile pair is one task's work
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    ahead = tiles.select("*", F.explode(steps).alias("s")).select(
        *cell, "tiles", (F.col("c0") + F.col("s.a")).alias("e0"), (F.col("c1") + F.col("s.b")).alias("e1")
    )
    others = tiles.select("label", "d", F.col("c0").alias("e0"), F.col("c1").alias("e1"), F.col("tiles").alias("more"))
    pairs = ahead.join(others, ["label", "d", "e0", "e1"])
    pairs = pairs.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pairs = pairs.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("more") - 1)))
    own = (F.col("c0") == F.col("e0")) & (F.col("c1") == F.col("e1"))
    pairs = pairs.where(~own | (F.col("i") <= F.col("j"))).withColumn("same", own & (F.col("i") == F.col("j")))
    pairs = pairs.withColumn("pair", F.xxhash64("label", "d", "c0", "c1", "e0", "e1", "i", "j"))
    pairs = phases.land(pairs, "pairs")
    dealt = placed.join(tiles, cell).withColumn("tile", F.expr("pmod(xxhash64(node), tiles)").cast("int"))
    left = dealt.join(pairs.select(*cell, F.col("i").alias("tile"), "pair", "same"), [*cell, "tile"])
    right = dealt.join(
        pairs.select("label", "d", F.col("e0").alias("c0"), F.col("e1").alias("c1"), F.col("j").alias("tile"), "pair", "same"),
        [*cell, "tile"],
    )
    columns = ["pair", "same", "node", "copies", "embedding"]
    right = right.select(*[F.col(c).alias(c) for c in columns])
    compared = left.select(*columns).groupBy("pair").cogroup(right.groupBy("pair"))
    compared = phases.land(compared.applyInArrow(_compare(axes, threshold), "node long, links long, u long, v long"), "compared")
    counts = compared.where("links >= 0").groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(compared.where("links < 0").select("u", "v"), phases)
    facts = groups.join(counts, "node", "left").join(parts, "node", "left")
    facts = phases.land(facts.select("h", "g", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component")), "facts")
    out = rows.join(facts, ["h", "g"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    links = F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long")
    return out.select(
        "vec_id", links.alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")
    )
