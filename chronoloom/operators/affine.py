"""Linear recursions over long series by affine maps of their blocks.

A recursion x_t = A x_{t-1} + b u_t takes a block of periods through one affine
map: x_end = M x_start + o.  Every block finds its map on its own, all at the same
time.  Maps compose, so the state at the start of every block is a scan over
as many maps as a series has blocks; then all blocks run from their true
start, again at the same time.  A period without input (u null) goes by another matrix,
``hole``.

Results do not depend on where blocks are cut, save for rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from chronoloom.operators import blocks
from chronoloom.operators.blocks import block_arrays, cut_lineage

#: Columns of a system: matrices row by row, the input's direction, the state before the first period.
SYSTEM = ("A", "b", "hole", "x0")


def _groups(sizes: list[int]) -> Iterator[tuple[int, list[int]]]:
    for r in sorted(set(sizes)):
        yield r, [i for i, s in enumerate(sizes) if s == r]


def _stack(values, index: list[int], *shape: int) -> np.ndarray:
    return np.stack([np.asarray(values.iloc[i], float).reshape(shape) for i in index])


def _inputs(us: pd.Series, index: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Padded inputs and their numbers; padding and missing inputs are NaN."""
    sizes = np.array([len(us.iloc[i]) for i in index])
    u = np.full((len(index), sizes.max(initial=0)), np.nan)
    for row, i in enumerate(index):
        u[row, :sizes[row]] = np.asarray(us.iloc[i], float)
    return u, sizes


def _map_of(us: pd.Series, a: pd.Series, b: pd.Series, hole: pd.Series) -> pd.DataFrame:
    """The affine map of each block: M (row by row) and o."""
    out: list = [None] * len(us)
    for r, index in _groups([len(x) for x in b]):
        A, B, H = _stack(a, index, r, r), _stack(b, index, r), _stack(hole, index, r, r)
        u, sizes = _inputs(us, index)
        x = np.zeros((len(index), r))
        for i in range(u.shape[1]):
            live, known = i < sizes, ~np.isnan(u[:, i])
            step = np.where(known[:, None, None], A, H) @ x[..., None]
            x = np.where(live[:, None], step[..., 0] + B * np.where(known, u[:, i], 0.0)[:, None], x)
        for row, i in enumerate(index):
            own = np.isnan(u[row, :sizes[row]])
            if not own.any():
                m = np.linalg.matrix_power(A[row], int(sizes[row]))
            else:  # runs of known and of missing inputs, each a power
                m, cuts = np.eye(r), np.flatnonzero(np.diff(own)) + 1
                for lo, hi in zip([0, *cuts], [*cuts, sizes[row]]):
                    m = np.linalg.matrix_power(H[row] if own[lo] else A[row], int(hi - lo)) @ m
            out[i] = (m.ravel(), x[row])
    return pd.DataFrame(out, columns=["M", "o"])


def _starts_of(maps: pd.Series, offsets: pd.Series, x0: pd.Series) -> pd.Series:
    """States before each block of a series, from the maps of its blocks in order."""
    out = []
    for ms, os, x in zip(maps, offsets, x0):
        x, own = np.asarray(x, float), []
        for m, o in zip(ms, os):
            own.append(x)
            with np.errstate(all="ignore"):
                x = np.asarray(m, float).reshape(len(x), len(x)) @ x + np.asarray(o, float)
        own.append(x)
        out.append(own)
    return pd.Series(out)


def _emit(wanted: list[int]):
    def run(us: pd.Series, a: pd.Series, b: pd.Series, hole: pd.Series, start: pd.Series) -> pd.Series:
        out: list = [None] * len(us)
        for r, index in _groups([len(x) for x in b]):
            A, B, H, x = _stack(a, index, r, r), _stack(b, index, r), _stack(hole, index, r, r), _stack(start, index, r)
            u, sizes = _inputs(us, index)
            keep = np.empty((u.shape[1], len(index), len(wanted)))
            at = [w if w < r else -1 for w in wanted]
            for i in range(u.shape[1]):
                known = ~np.isnan(u[:, i])
                x = (np.where(known[:, None, None], A, H) @ x[..., None])[..., 0] + B * np.where(known, u[:, i], 0.0)[:, None]
                keep[i] = x[:, at]
            for row, i in enumerate(index):
                out[i] = keep[:sizes[row], row].tolist()
        return pd.Series(out)
    return pandas_udf(run, "array<array<double>>")


def affine_scan(df: DataFrame, by: list[str], t: str, u: str, system: DataFrame, emit: dict[str, int], carry: list[str] = (),
                block: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Run x_t = A x_{t-1} + b u_t along every series.

    ``system`` has one row per key with the columns of SYSTEM; keys without one
    give no rows.  Returns the rows (keys, t, ``carry``, and the components of
    x_t named by ``emit``) and one row per key with the last state ``x`` as an array.
    Rows of a key need distinct ``t``; missing periods must be there as rows
    with a null input.  An empty frame gives two empty frames.
    """
    block = block or blocks.BLOCK
    rows = df.select(*by, t, F.col(u).cast("double").alias("_u"), *carry)
    arrays = cut_lineage(block_arrays(rows, by, t, ["_u", *carry], block).join(system.select(*by, *SYSTEM), by))
    us = F.col("pts")["_u"]
    maps = arrays.select(*by, "blk", "x0", pandas_udf(_map_of, "struct<M:array<double>,o:array<double>>")(us, "A", "b", "hole").alias("_f"))
    # one small map for each block of a series
    scan = maps.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("blk", "_f.M", "_f.o"))).alias("_m"), F.first("x0").alias("x0"))
    scan = cut_lineage(scan.select(*by, F.col("_m.blk").alias("_blks"), pandas_udf(_starts_of, "array<array<double>>")(F.col("_m.M"), F.col("_m.o"), "x0").alias("_x")))
    last = scan.select(*by, F.element_at("_x", -1).alias("x"))
    starts = scan.select(*by, F.explode(F.arrays_zip(F.col("_blks").alias("blk"), F.slice("_x", F.lit(1), F.size("_blks")).alias("_start"))).alias("_z")).select(
        *by, F.col("_z.blk").alias("blk"), F.col("_z._start").alias("_start"))
    out = arrays.join(starts, [*by, "blk"]).select(*by, F.explode(F.arrays_zip("pts", _emit(list(emit.values()))(us, "A", "b", "hole", "_start").alias("_s"))).alias("_z"))
    out = out.select(*by, F.col(f"_z.pts.{t}").alias(t), *[F.col(f"_z.pts.{c}").alias(c) for c in carry],
                     *[F.col("_z._s")[i].alias(name) for i, name in enumerate(emit)])
    return out, last


def companion(theta: list[float]) -> tuple[list[float], list[float], list[float]]:
    """(A, b, hole) of e_t = u_t - theta_1 e_{t-1} - ...; a period without input has e_t = 0."""
    r = len(theta)
    shift = np.eye(r, k=-1)
    a = shift.copy()
    a[0] -= theta
    return a.ravel().tolist(), [1.0] + [0.0] * (r - 1), shift.ravel().tolist()
