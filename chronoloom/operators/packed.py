"""Sparse linear algebra on DataFrames with many right-hand sides.

A matrix is a frame of entries, a block of vectors a frame (id, x) whose arrays
hold one number for each vector.  Products join the two and add up arrays: each
Arrow batch adds its own first, then the partial sums of an id stream through one task,
one after the other, so no group is ever collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoloom.operators.blocks import cut_lineage

VECTORS = "id string, x array<double>"
#: Systems whose entries times vectors are no more than this are solved by one task, in the same steps.
SMALL = 10_000_000


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def lists(m: np.ndarray) -> pa.Array:
    ends = np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(m, float).ravel()))


def _sums(ids: pa.Array, m: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Sums of the rows of each id of a batch, ids in ascending order."""
    coded = ids.dictionary_encode()
    code = np.asarray(coded.indices)
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.diff(code[order], prepend=-1))
    sums = np.add.reduceat(m[order], starts, axis=0)
    names = coded.dictionary
    rank = np.argsort(np.array(names.to_pylist(), object), kind="stable")
    return names.take(pa.array(rank)), sums[rank]


def add_up(vectors: DataFrame, width: int) -> DataFrame:
    """(id, x): the sum of the arrays of each id."""
    def partial(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                ids, sums = _sums(part.column("id"), matrix(part.column("x"), width))
                yield pa.RecordBatch.from_arrays([ids, lists(sums)], ["id", "x"])

    def total(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for part in parts:
            if not part.num_rows:
                continue
            ids, sums = _sums(part.column("id"), matrix(part.column("x"), width))
            names = ids.to_pylist()
            if names[0] == last:
                sums[0] += held
            elif last is not None:
                yield pa.RecordBatch.from_arrays([pa.array([last]), lists(held[None])], ["id", "x"])
            if len(names) > 1:
                yield pa.RecordBatch.from_arrays([ids[:-1], lists(sums[:-1])], ["id", "x"])
            last, held = names[-1], sums[-1].copy()
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), lists(held[None])], ["id", "x"])

    return vectors.mapInArrow(partial, VECTORS).repartition("id").sortWithinPartitions("id").mapInArrow(total, VECTORS)


def multiply(entries: DataFrame, source: str, target: str, vectors: DataFrame, width: int) -> DataFrame:
    """(id, x): for every ``target`` the sum of v times the vector of ``source`` over its entries."""
    def scaled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                m = matrix(part.column("x"), width) * np.asarray(part.column("v"))[:, None]
                ids, sums = _sums(part.column("id"), m)
                yield pa.RecordBatch.from_arrays([ids, lists(sums)], ["id", "x"])

    pairs = entries.select(F.col(source).alias("_s"), F.col(target).alias("_t"), "v").join(
        vectors.select(F.col("id").alias("_s"), "x"), "_s").select(F.col("_t").alias("id"), "v", "x")
    return add_up(pairs.mapInArrow(scaled, VECTORS), width)


def pack(entries: DataFrame, width: int) -> DataFrame:
    """(id, x) from entries (id, i, v) with i in 0..width-1; what is missing is 0."""
    def dense(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                cells = part.column("cells")
                rows = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(cells.offsets)))
                flat = cells.flatten()
                m = np.zeros((part.num_rows, width))
                m[rows, np.asarray(flat.field("i"))] = np.asarray(flat.field("v"))
                yield pa.RecordBatch.from_arrays([part.column("id"), lists(m)], ["id", "x"])

    # at most ``width`` entries an id
    cells = entries.groupBy("id").agg(F.collect_list(F.struct(F.col("i").cast("int").alias("i"), F.col("v").cast("double").alias("v"))).alias("cells"))
    return cells.mapInArrow(dense, VECTORS)


def _dots(state: DataFrame, width: int) -> np.ndarray:
    """Rows p.z, r.z, z.z, r.r for every vector."""
    def partial(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, width))
        for part in parts:
            if part.num_rows:
                r, p, z = (matrix(part.column(c), width) for c in ("r", "p", "z"))
                total += np.stack([(p * z).sum(axis=0), (r * z).sum(axis=0), (z * z).sum(axis=0), (r * r).sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(["all"]), lists(total.ravel()[None])], ["id", "x"])

    found = add_up(state.mapInArrow(partial, VECTORS), 4 * width).first()
    return np.array(found.x).reshape(4, width) if found else np.zeros((4, width))


def _solve_here(row: np.ndarray, col: np.ndarray, v: np.ndarray, r: np.ndarray, tol: float, steps: int) -> np.ndarray:
    """The steps of ``solve_gram`` on arrays; ``row`` and ``col`` number the entries' rows and columns."""
    by_row, by_col = np.argsort(row, kind="stable"), np.argsort(col, kind="stable")
    ends = lambda order, of: (order, np.flatnonzero(np.diff(of[order], prepend=-1)))
    rows, cols = ends(by_row, row), ends(by_col, col)
    add = lambda way, m: np.add.reduceat(m[way[0]], way[1], axis=0)
    scale = 1 / np.sqrt(add(rows, (v * v)[:, None]))
    v = v * scale[row, 0]
    r = r * scale
    x, p, rr = np.zeros_like(r), r.copy(), (r * r).sum(axis=0)
    first = rr
    for _ in range(steps):
        z = add(rows, v[:, None] * add(cols, v[:, None] * p[row])[col])
        pz = (p * z).sum(axis=0)
        live = (rr > tol ** 2 * first) & (pz > 0)
        if not live.any():
            return x * scale
        with np.errstate(all="ignore"):
            alpha = np.where(live, rr / pz, 0.0)
        x, r = x + alpha * p, r - alpha * z
        new = (r * r).sum(axis=0)
        with np.errstate(all="ignore"):
            p, rr = r + np.where(live, new / rr, 0.0) * p, new
    raise RuntimeError(f"no convergence in {steps} steps")


def _solve_in_one_task(entries: DataFrame, rhs: DataFrame, width: int, tol: float, steps: int) -> DataFrame:
    both = entries.select("row", "col", "v", F.lit(None).cast("array<double>").alias("x")).unionByName(
        rhs.select(F.col("id").alias("row"), F.lit(None).cast("string").alias("col"), F.lit(None).cast("double").alias("v"), "x"))

    def solve(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(parts)) if (parts := list(parts)) else None
        if table is None or not table.num_rows:
            return
        is_rhs = np.asarray(table.column("x").is_valid())
        system, right = table.filter(pa.array(~is_rhs)), table.filter(pa.array(is_rhs))
        code = lambda c: c.combine_chunks().dictionary_encode()
        row, col = code(system.column("row")), code(system.column("col"))
        names = row.dictionary.to_pylist()
        at = {n: i for i, n in enumerate(names)}
        r = np.zeros((len(names), width))
        if right.num_rows:
            values = matrix(right.column("x").combine_chunks(), width)
            for i, n in enumerate(right.column("row").to_pylist()):
                r[at[n]] = values[i]
        x = _solve_here(np.asarray(row.indices), np.asarray(col.indices), np.asarray(system.column("v")), r, tol, steps)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), lists(x)], ["id", "x"])

    return both.repartition(1).mapInArrow(solve, VECTORS)


def solve_gram(entries: DataFrame, rhs: DataFrame, width: int, tol: float = 1e-11, steps: int = 2_000) -> DataFrame:
    """(id, x) with (B B') x = rhs, by conjugate gradients for all vectors at once.

    ``entries`` (row, col, v) are those of B, which is only ever multiplied by;
    rows are scaled so that B B' has ones on its diagonal.  Stops when every
    residual is below ``tol`` of its right-hand side; a vector that is there
    already, or zero, stands still.  Each step writes its state, so a lost
    executor costs one step.  A system of up to SMALL numbers, counted first, is
    one task's work.
    """
    if (entries.count() + rhs.count()) * width <= SMALL:
        return cut_lineage(_solve_in_one_task(entries, rhs, width, tol, steps))
    size = entries.groupBy(F.col("row").alias("id")).agg((1 / F.sqrt(F.sum(F.col("v") * F.col("v")))).alias("_s"))
    size = cut_lineage(size)
    b = cut_lineage(entries.join(size.withColumnRenamed("id", "row"), "row").select("row", "col", (F.col("v") * F.col("_s")).alias("v")))
    scale = lambda df: df.join(size, "id").select("id", F.transform("x", lambda e: e * F.col("_s")).alias("x"))
    state = scale(rhs).select("id", F.transform("x", lambda e: F.lit(0.0)).alias("x"), F.col("x").alias("r"), F.col("x").alias("p"))
    names, first, shape = ("x", "r", "p"), None, "id string, x array<double>, r array<double>, p array<double>"
    for _ in range(steps):
        z = multiply(b, "col", "row", multiply(b, "row", "col", state.select("id", F.col("p").alias("x")), width), width)
        moved = cut_lineage(state.join(z.select("id", F.col("x").alias("z")), "id"))
        pz, rz, zz, rr = _dots(moved, width)
        first = rr if first is None else first
        live = (rr > tol ** 2 * first) & (pz > 0)
        with np.errstate(all="ignore"):
            alpha = np.where(live, rr / pz, 0.0)
            new = np.maximum(rr - 2 * alpha * rz + alpha ** 2 * zz, 0.0)
            beta = np.where(live, new / rr, 0.0)

        def step(parts: Iterator[pa.RecordBatch], alpha=alpha, beta=beta) -> Iterator[pa.RecordBatch]:
            for part in parts:
                if part.num_rows:
                    x, r, p, z = (matrix(part.column(c), width) for c in (*names, "z"))
                    r = r - alpha * z
                    yield pa.RecordBatch.from_arrays([part.column("id"), lists(x + alpha * p), lists(r), lists(r + beta * p)], ["id", *names])

        state = moved.mapInArrow(step, shape)
        if not (live & (new > tol ** 2 * first)).any():
            return scale(state.select("id", "x"))
    raise RuntimeError(f"no convergence in {steps} steps")
