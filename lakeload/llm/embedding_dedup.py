"""Embedding near-dedup by PCA-ordered tiled comparison.

Vectors are scaled to length one, turned into a principal-axes basis (any orthonormal basis gives the same
cosines, so fitting it on a bounded sample loses nothing) and sorted by their first coordinate into tiles.
Tiles whose first coordinates are further apart than similar vectors can be never meet. Within a pair of
tiles, leading coordinates are multiplied first; the product of the suffix norms bounds what is left, and
a pair is dropped as soon as its cosine cannot reach the threshold. What remains is computed in double
precision. Exact copies are one vector with a multiplicity.

Work is the number of tile pairs within reach, each a bounded piece; a tile pair reports links per vector
and a spanning set of links, never all of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeload.llm.common import stored
from lakeload.llm.components import connected_components

NO_ID = 2 ** 63 - 1
MARGIN = 1e-4
_TILE = "tile long, low double, high double, n long, id binary, k1 binary, k2 binary, copies binary, vec binary"


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def principal_axes(units: np.ndarray) -> np.ndarray:
    """Orthonormal columns, by falling variance of the unit vectors around zero."""
    _, axes = np.linalg.eigh(units.T @ units)
    return np.ascontiguousarray(axes[:, ::-1])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _first_coordinate(axes: np.ndarray):
    dim = len(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            first = unit_rows(_matrix(batch.column(4), dim)) @ axes[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first)],
                                             names=["k1", "k2", "id", "copies", "vec", "first"])

    return run


def _tiles(dim: int, rows: int):
    """Tiles of at most ``rows`` vectors from rows sorted by the first coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number, held = TaskContext.get().partitionId() << 32, 0, []

        def out(part: pa.Table) -> pa.RecordBatch:
            part = part.combine_chunks()
            first = part.column("first").to_numpy()
            vec = _matrix(part.column("vec").combine_chunks(), dim)
            cells = [base + number, first.min(), first.max(), len(first)]
            cells += [part.column(c).to_numpy().tobytes() for c in ("id", "k1", "k2", "copies")] + [vec.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([c]) for c in cells],
                                              names=["tile", "low", "high", "n", "id", "k1", "k2", "copies", "vec"])

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            while sum(len(t) for t in held) >= rows:
                every = pa.concat_tables(held)
                yield out(every.slice(0, rows))
                held, number = [every.slice(rows)], number + 1
        if sum(len(t) for t in held):
            yield out(pa.concat_tables(held))

    return run


class _Side:
    """Vectors of one group of tiles, in order of the first coordinate."""

    def __init__(self, table: pa.Table, axes: np.ndarray, steps: list[int]):
        read = lambda c, t: np.concatenate([np.frombuffer(x.as_py(), t) for x in table.column(c)])
        self.id, self.k1, self.k2, self.copies = (read(c, np.int64) for c in ("id", "k1", "k2", "copies"))
        units = unit_rows(read("vec", np.float64).reshape(len(self.id), -1))
        first = units @ axes[:, 0]
        order = np.argsort(first, kind="stable")
        self.id, self.k1, self.k2, self.copies = (x[order] for x in (self.id, self.k1, self.k2, self.copies))
        self.units, self.first = units[order], first[order]
        self.turned = (self.units @ axes).astype(np.float32)
        self.rest = [np.sqrt((self.turned[:, s:] ** 2).sum(axis=1)) for s in steps]
        self.links = np.zeros(len(self.id), np.int64)


def _similar_pairs(a: _Side, b: _Side, rows: slice, cols: slice, steps: list[int], threshold: float):
    """Mask of the block's pairs with cosine >= threshold, or None."""
    floor = threshold - MARGIN
    low = a.turned[rows, :steps[0]] @ b.turned[cols, :steps[0]].T
    open_ = low + a.rest[0][rows, None] * b.rest[0][None, cols] >= floor
    count = np.count_nonzero(open_)
    if not count:
        return None
    if count * 8 > open_.size:
        return a.units[rows] @ b.units[cols].T >= threshold
    i, j = np.nonzero(open_)
    partial = low[i, j]
    for k in range(1, len(steps)):
        s, e = steps[k - 1], steps[k]
        partial = partial + np.einsum("ij,ij->i", a.turned[rows][i, s:e], b.turned[cols][j, s:e])
        good = partial + a.rest[k][rows][i] * b.rest[k][cols][j] >= floor
        i, j, partial = i[good], j[good], partial[good]
    good = np.einsum("ij,ij->i", a.units[rows][i], b.units[cols][j]) >= threshold
    if not good.any():
        return None
    mask = np.zeros(open_.shape, bool)
    mask[i[good], j[good]] = True
    return mask


def _spanning(mask: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the mask connects, at most one per row and column (all, if they are few)."""
    if np.count_nonzero(mask) <= sum(mask.shape):
        i, j = np.nonzero(mask)
        return rows[i], cols[j]
    big = np.iinfo(np.int64).max
    left, right = rows.copy(), cols.copy()
    while True:
        new_left = np.minimum(left, np.where(mask, right[None, :], big).min(axis=1))
        new_right = np.minimum(right, np.where(mask, new_left[:, None], big).min(axis=0))
        if (new_left == left).all() and (new_right == right).all():
            break
        left, right = new_left, new_right
    return np.concatenate((rows, cols)), np.concatenate((left, right))


def _compare(axes: np.ndarray, threshold: float, block: int = 1024):
    dim = len(axes)
    steps = sorted({min(dim, s) for s in (16, 32, 64)} | {dim})
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + MARGIN

    def run(table: pa.Table) -> pa.Table:
        one, two = table.column("ga")[0].as_py(), table.column("gb")[0].as_py()
        g = table.column("g").to_numpy()
        a = _Side(table.filter(pa.array(g == one)), axes, steps)
        b = a if one == two else _Side(table.filter(pa.array(g == two)), axes, steps)
        ends = []
        for r in range(0, len(a.id), block):
            rows = slice(r, min(r + block, len(a.id)))
            for c in range(r if a is b else 0, len(b.id), block):
                cols = slice(c, min(c + block, len(b.id)))
                if max(b.first[cols.start] - a.first[rows.stop - 1], a.first[rows.start] - b.first[cols.stop - 1]) > reach:
                    continue
                mask = _similar_pairs(a, b, rows, cols, steps, threshold)
                if mask is None:
                    continue
                same = a is b and r == c
                if same:
                    np.fill_diagonal(mask, False)
                a.links[rows] += mask @ b.copies[cols]
                if not same:
                    b.links[cols] += a.copies[rows] @ mask
                ends.append(_spanning(mask, a.id[rows], b.id[cols]))
        parts = [(s.k1[s.links > 0], s.k2[s.links > 0], s.links[s.links > 0]) for s in ([a] if a is b else [a, b])]
        k1, k2, links = (np.concatenate(x) for x in zip(*parts, strict=True))
        x, y = (np.concatenate(e) for e in zip(*ends, strict=True)) if ends else (np.empty(0, np.int64),) * 2
        edges = np.unique(np.stack([x, y]), axis=1)
        edges = edges[:, edges[0] != edges[1]]
        n, m = len(links), edges.shape[1]
        return pa.table({
            "k1": pa.concat_arrays([pa.array(k1), pa.nulls(m, pa.int64())]),
            "k2": pa.concat_arrays([pa.array(k2), pa.nulls(m, pa.int64())]),
            "links": pa.concat_arrays([pa.array(links), pa.nulls(m, pa.int64())]),
            "a": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(edges[0])]),
            "b": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(edges[1])])})

    return run


def _links(vectors: DataFrame, dim: int, count: int, threshold: float, tile_rows: int, fit_rows: int) -> DataFrame:
    """Link counts and spanning links of the distinct vectors of one dimension."""
    sample = vectors.orderBy("k1", "k2").limit(fit_rows).select("vec").collect()
    axes = principal_axes(unit_rows(np.array([r["vec"] for r in sample], dtype=np.float64)))
    placed = vectors.mapInArrow(_first_coordinate(axes), "k1 long, k2 long, id long, copies long, vec array<double>, first double")
    tiles = stored(placed.repartitionByRange(-(-count // tile_rows), "first").sortWithinPartitions("first")
                   .mapInArrow(_tiles(dim, tile_rows), _TILE), "tiles")
    # Small tiles are compared in groups of about tile_rows vectors; this window has one row per tile.
    upto = F.sum("n").over(Window.orderBy("low", "tile"))
    groups = tiles.select("tile", "low", "high", "n").select(
        "tile", "low", "high", F.floor((upto - F.col("n")) / tile_rows).alias("g"))
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + MARGIN
    bounds = groups.groupBy("g").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    slot = lambda c: F.floor(c / F.lit(max(reach, 0.01)))
    one = bounds.select(F.col("g").alias("ga"), F.col("low").alias("low_a"), F.col("high").alias("high_a"),
                        F.explode(F.sequence(slot(F.col("low") - reach), slot(F.col("high") + reach))).alias("slot"))
    two = bounds.select(F.col("g").alias("gb"), F.col("low").alias("low_b"), F.col("high").alias("high_b"),
                        F.explode(F.sequence(slot(F.col("low")), slot(F.col("high")))).alias("slot"))
    pairs = (one.join(two, "slot").where("ga <= gb").where(F.col("low_b") - F.col("high_a") <= reach)
             .where(F.col("low_a") - F.col("high_b") <= reach).select("ga", "gb").distinct())
    sides = pairs.select("ga", "gb", F.explode(F.array_distinct(F.array("ga", "gb"))).alias("g"))
    dealt = tiles.join(groups.select("tile", "g"), "tile").join(sides, "g")
    return dealt.select("ga", "gb", "g", "id", "k1", "k2", "copies", "vec").groupBy("ga", "gb").applyInArrow(
        _compare(axes, threshold), "k1 long, k2 long, links long, a long, b long")


def embedding_components(vectors: DataFrame, threshold: float = 0.9, tile_rows: int = 4096, fit_rows: int = 4096,
                         vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Rows link when their cosine is at least ``threshold`` in double precision. ``n_links`` counts the other
    rows linked directly, ``component_id`` is the smallest id reachable, and ``kept`` marks the row with it.

    Null, empty and zero vectors, and those with a null or non-finite component, link with nothing, and
    neither do vectors of different length. Repeated rows are copies of each other. Rows sharing an id (or
    lacking one, which sorts last) share a component. No rows give no rows.
    """
    values = F.transform(F.col(f"`{embedding}`").cast("array<double>"), lambda x: x + F.lit(0.0))
    sound = (F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("vec", lambda x: x != 0)
    rows = vectors.select(F.coalesce(F.col(f"`{vec_id}`").cast("long"), F.lit(NO_ID)).alias("id"), values.alias("vec"))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    keyed = rows.where("sound").select("id", "vec", F.xxhash64("vec").alias("k1"), F.xxhash64(F.lit(1), "vec").alias("k2"))
    distinct = stored(keyed.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.count("*").alias("copies"),
                                                    F.any_value("vec").alias("vec")), "vectors")
    found = None
    for row in distinct.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n")).orderBy("dim").collect():
        own = distinct.where(F.size("vec") == row["dim"])
        part = _links(own, row["dim"], row["n"], threshold, tile_rows, fit_rows)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return rows.select(_id(F.col("id")).alias(vec_id), F.lit(0).cast("long").alias("n_links"),
                           _id(F.col("id")).alias("component_id"), F.lit(True).alias("kept"))
    found = stored(found, "links")
    classes = distinct.select("k1", "k2", F.col("id").alias("class"), "copies").join(
        found.where("links is not null").groupBy("k1", "k2").agg(F.sum("links").alias("links")), ["k1", "k2"], "left")
    same = keyed.select("id", "k1", "k2").join(classes.select("k1", "k2", "class"), ["k1", "k2"]).where("id <> class")
    roots = connected_components(found.where("a is not null").select("a", "b").unionAll(
        same.select(F.col("id").alias("a"), F.col("class").alias("b"))))
    out = (keyed.select("id", "k1", "k2").join(classes, ["k1", "k2"])
           .select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
           .unionAll(rows.where("not sound").select("id", F.lit(0).cast("long").alias("n_links")))
           .join(roots, F.col("id") == F.col("node"), "left"))
    component = F.coalesce("root", "id")
    return out.select(_id(F.col("id")).alias(vec_id), F.col("n_links").cast("long"), _id(component).alias("component_id"),
                      (F.col("id") == component).alias("kept"))


def _id(value: F.Column) -> F.Column:
    return F.when(value != NO_ID, value)
