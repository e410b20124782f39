"""Centroid clustering with Ptolemaic pivots.

For four points of Euclidean space Ptolemy's inequality gives
d(x, c) d(p, s) >= |d(x, p) d(c, s) - d(x, s) d(c, p)|.  The pivots p, s are the
starting vectors and stay as they are, so each vector's distances to them are computed once and kept in a
table; a round needs only the distances of its centroids to the pivots to bound
every distance from below.  The centroid with the smallest bound is measured
first; whatever has a bound above that distance, after rounding against the
bound, cannot win or tie and is left out; all others are measured exactly in
integers.  Tasks add their vectors up; centroids and their sums are a few numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.common import written

#: Relative error allowed for in each product of two rounded distances, and in each quotient.
SLACK = 2.0**-48
#: Sums travel as limbs of so many bits.
LIMB = 40
LONGEST = 2**63 - 1
SUMS = "cluster int, pos int, limb int, value long"


def whole_vectors(vectors: DataFrame, dim: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x): vectors of ``dim`` components, none of them null or non-finite."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return vectors.where(x.isNotNull() & (F.size(x) == dim) & ~bad).select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, lambda e: e.cast("double")).alias("x"))


def room(dim: int) -> int:
    """Components up to this size have squared distances that fit 63 bits."""
    return math.isqrt(2**62 // max(dim, 1)) // 2


def on_grid(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x): 64-bit integers where all distances fit them, Python integers otherwise."""
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if not y.size or np.abs(y).max() <= room(x.shape[1]):
        return y.astype(np.int64)
    exact = [[int(b) if math.isfinite(b) else math.floor(Fraction(a) * Fraction(scale)) for a, b in zip(xs, ys)]
             for xs, ys in zip(x.tolist(), y.tolist())]
    return np.array(exact, object)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two matrices, pair by pair."""
    d = a - b
    return (d * d).sum(axis=1)


def rounded(n: np.ndarray) -> np.ndarray:
    """Square roots as floating point numbers, infinite where they do not fit."""
    if n.dtype == object:
        flat = [math.inf if v >> 1000 else math.sqrt(v) for v in n.ravel().tolist()]
        return np.array(flat, float).reshape(n.shape)
    return np.sqrt(n.astype(np.float64))


def table_of(v: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Rounded distances of every row to every point."""
    if not len(points):
        return np.empty((len(v), 0))
    return np.stack([rounded(squared(v, p[None])) for p in points], axis=1)


class Round:
    """The centroids of one round and what bounds need to know of them."""

    def __init__(self, centres: np.ndarray, pivots: np.ndarray):
        self.centres = centres
        far = table_of(centres, pivots)
        between = table_of(pivots, pivots)
        n = len(pivots)
        ring = [(p, (p + 1) % n) for p in range(n)] if n > 2 else [(0, 1)][:n - 1]
        self.pairs = [(p, s) for p, s in ring if 0 < between[p, s] < math.inf]
        self.far, self.between = far, between

    def bounds(self, far: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances of every row (given by its distances to the pivots) to every centroid."""
        low = np.zeros((len(far), len(self.centres)))
        with np.errstate(over="ignore", invalid="ignore"):
            for p, s in self.pairs:
                one = far[:, p:p + 1] * self.far[None, :, s]
                two = far[:, s:s + 1] * self.far[None, :, p]
                own = (np.abs(one - two) - SLACK * (one + two)) / self.between[p, s] * (1 - SLACK)
                np.fmax(low, np.where(np.isfinite(own), own, 0.0), out=low)
        return low

    def assign(self, v: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid (the smaller number of equals), the squared distance, and how many distances were measured."""
        low = self.bounds(far)
        rows = np.arange(len(v))
        first = low.argmin(axis=1)
        near = squared(v, self.centres[first])
        left = low <= (rounded(near) * (1 + SLACK))[:, None]
        left[rows, first] = False
        best = first.astype(np.int32)
        for c in range(len(self.centres)):
            at = np.flatnonzero(left[:, c])
            if len(at):
                d = squared(v[at], self.centres[c][None])
                better = (d < near[at]) | ((d == near[at]) & (c < best[at]))
                near[at[better]], best[at[better]] = d[better], c
        return best, near, len(v) + int(left.sum())


def _vectors(part: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    return np.asarray(part.column(column).flatten()).reshape(part.num_rows, width)


def same_kind(*arrays: np.ndarray) -> list[np.ndarray]:
    """Python integers for all if any has them."""
    return [a.astype(object) for a in arrays] if any(a.dtype == object for a in arrays) else list(arrays)


def _matrix(rows: list[list[int]], dim: int) -> np.ndarray:
    if any(abs(c) > room(dim) for r in rows for c in r):
        return np.array(rows, object).reshape(len(rows), dim)
    return np.array(rows, np.int64).reshape(len(rows), dim)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(limb, value) pairs whose sums put sums together again; each carries the sign."""
    sign, value, i = (-1 if value < 0 else 1), abs(value), 0
    while value:
        if value & ((1 << LIMB) - 1):
            yield i, sign * (value & ((1 << LIMB) - 1))
        value, i = value >> LIMB, i + 1


def cached(rows: DataFrame, pivots: list[list[int]], dim: int, scale: float) -> DataFrame:
    """(id, x, far): every vector with its distances to the pivots."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            v, p = same_kind(on_grid(_vectors(part, "x", dim), scale), _matrix(pivots, dim))
            far = table_of(v, p)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * far.shape[1]), pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("x"), lists], ["id", "x", "far"])

    return rows.mapInArrow(batches, "id long, x array<double>, far array<double>")


def _assigned(part: pa.RecordBatch, centres: list[list[int]], pivots: list[list[int]], dim: int, scale: float):
    v, c, p = same_kind(on_grid(_vectors(part, "x", dim), scale), _matrix(centres, dim), _matrix(pivots, dim))
    return v, *Round(c, p).assign(v, _vectors(part, "far", len(pivots)))


def sums_of(rows: DataFrame, centres: list[list[int]], pivots: list[list[int]], dim: int, scale: float) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of each non-empty cluster: tasks send one row for each number, which Spark adds up."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centres), np.int64)
        total = np.zeros((len(centres), dim), object)
        for part in parts:
            v, best, _, _ = _assigned(part, centres, pivots, dim, scale)
            for c in np.unique(best).tolist():
                own = v[best == c]
                count[c] += len(own)
                total[c] += own.sum(axis=0).astype(object)
        out = [(c, -1, 0, n) for c, n in enumerate(count.tolist()) if n]
        out += [(c, i, limb, value) for c, n in enumerate(count.tolist()) if n for i, t in enumerate(total[c]) for limb, value in limbs(int(t))]
        if out:
            c, i, limb, value = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(i, pa.int32()), pa.array(limb, pa.int32()), pa.array(value, pa.int64())],
                                             ["cluster", "pos", "limb", "value"])

    merged = rows.mapInArrow(batches, SUMS).groupBy("cluster", "pos", "limb").agg(F.sum("value").alias("value"))
    found: dict[int, tuple[int, list[int]]] = {}
    for r in merged.collect():  # as many rows as the centroids have numbers
        count, total = found.get(r.cluster, (0, [0] * dim))
        if r.pos < 0:
            count = r.value
        else:
            total[r.pos] += r.value << (LIMB * r.limb)
        found[r.cluster] = (count, total)
    return found


def clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: float = 1024.0, salt: str = "3:",
             id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, measured) for every whole vector.

    Lloyd's rounds on floor(scale * x).  Centroids start as the ``k`` vectors with
    the smallest sha256 of ``salt`` and id (all of them, if there are fewer; equal
    hashes go by the components), ties of distance go to the smaller number, an
    empty cluster keeps its centroid.  Rows that repeat an id count as vectors of
    their own; rows without id are clustered but never start a cluster, unless no
    others are left; null vectors, other lengths and null or non-finite components
    take no part; further columns are left out; an empty table gives no rows.
    Components of any finite size are computed exactly; a distance or a sum of
    distances beyond a long is given as the largest long.  ``measured``: distances
    of the vector's batch that the bounds left to be measured, per vector.
    """
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, dim, id_col, vector_col)
    order = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    start = rows.orderBy(order.asc_nulls_last(), "x").limit(k).select("x").collect()
    centres = [on_grid(np.array([r.x], float).reshape(1, dim), scale)[0].tolist() for r in start]
    pivots = [list(c) for c in centres]
    table = written(cached(rows, pivots, dim, scale), "pivot-distances")
    for _ in range(rounds):
        for c, (n, total) in sums_of(table, centres, pivots, dim, scale).items():
            centres[c] = [t // n for t in total]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            _, best, near, measured = _assigned(part, centres, pivots, dim, scale)
            if near.dtype == object:
                near = np.array([min(d, LONGEST) for d in near.tolist()], np.int64)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(best), pa.array(near), pa.array(np.full(len(best), measured / max(len(best), 1)))],
                                             ["vec_id", "cluster", "distance", "measured"])

    final = written(table.mapInArrow(batches, "vec_id long, cluster int, distance long, measured double"), "clusters")
    found = {r.cluster: int(r.s) for r in final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    inertia = min(sum(found.values()), LONGEST)
    known = [(c, min(s, LONGEST), inertia, hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for c, s in sorted(found.items())]
    names = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row for each of the k clusters
    return final.join(F.broadcast(names), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "measured")
