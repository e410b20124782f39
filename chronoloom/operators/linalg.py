"""Least squares per key from cross-product sums.

Tasks reduce their rows to p x p sums; only those sums are shuffled.  The small
systems are solved in Arrow batches of sums, one row per key or candidate.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

JVM_COLUMNS = 14     # up to here the sums are plain SQL aggregates


def gram(df: DataFrame, by: list[str], xs: list[str], y: str | list[str]) -> DataFrame:
    """Rows (by, p, k, n, g): ``g`` is the flattened (p+k) x (p+k) cross product
    of [xs, ys], ``n`` the complete rows.  Rows with a NULL are left out."""
    ys = [y] if isinstance(y, str) else list(y)
    cols = [*xs, *ys]
    ok = None
    for c in cols:
        ok = F.col(c).isNotNull() if ok is None else ok & F.col(c).isNotNull()
    df = df.where(ok)
    q = len(cols)
    if q <= JVM_COLUMNS:
        sums = {(i, j): f"_g{i}_{j}" for i in range(q) for j in range(i, q)}
        agg = df.groupBy(*by).agg(F.count("*").alias("n"), *[
            F.sum(F.col(cols[i]).cast("double") * F.col(cols[j])).alias(a) for (i, j), a in sums.items()])
        flat = F.array(*[F.col(sums[min(i, j), max(i, j)]) for i in range(q) for j in range(q)])
        return agg.select(*by, F.lit(len(xs)).alias("p"), F.lit(len(ys)).alias("k"), "n", flat.alias("g"))
    vec = df.select(*by, F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"))
    return gram_arrays(vec, by, "_x", len(xs), len(ys))


def gram_arrays(df: DataFrame, by: list[str], x: str, p: int, k: int) -> DataFrame:
    """Same from an array column [xs, ys], for wide designs."""
    q = p + k
    key = F.to_json(F.struct(*by)) if by else F.lit("")
    keyed = df.select(key.alias("_key"), x)

    def partial(batches):
        name, n, g = None, 0, None
        for pdf in batches:
            for key_, part in pdf.groupby("_key", sort=False)[x]:
                m = np.stack(part.to_numpy())
                if key_ != name:
                    if name is not None:
                        yield pd.DataFrame({"_key": [name], "n": [n], "g": [g.ravel()]})
                    name, n, g = key_, 0, np.zeros((q, q))
                n += len(m)
                g += m.T @ m
        if name is not None:
            yield pd.DataFrame({"_key": [name], "n": [n], "g": [g.ravel()]})

    # rows of a key stand together, so a task sends one array for each of its keys, however many there are
    parts = keyed.sortWithinPartitions("_key").mapInPandas(partial, "_key string, n long, g array<double>")
    none = F.array_repeat(F.lit(0.0), q * q)
    out = parts.groupBy("_key").agg(F.sum("n").alias("n"), F.collect_list("g").alias("_g")).select(
        "_key", "n", F.aggregate("_g", none, lambda s, v: F.zip_with(s, v, lambda a, b: a + b)).alias("g"))
    if by:
        types = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)
        out = out.withColumn("_k", F.from_json("_key", types))
        keys = [F.col(f"_k.`{c}`").alias(c) for c in by]
    else:
        keys = []
    return out.select(*keys, F.lit(p).alias("p"), F.lit(k).alias("k"), "n", "g")


_FIT = ("struct<beta:array<double>,se:array<double>,xtx_inv:array<double>,sse:double,sst:double,r2:double,"
        "adj_r2:double,sigma2:double,loglik:double,aic:double,aicc:double,bic:double>")


def _solve(p: pd.Series, n: pd.Series, g: pd.Series, keep: pd.Series) -> pd.DataFrame:
    rows = []
    for pi, ni, gi, ki in zip(p, n, g, keep):
        q = int(round(len(gi) ** 0.5))
        full = np.asarray(gi, float).reshape(q, q)
        idx = np.arange(pi) if ki is None else np.asarray(ki, int)
        xtx, xty, yty = full[np.ix_(idx, idx)], full[idx, pi], full[pi, pi]
        m = len(idx)
        inv = np.linalg.pinv(xtx, hermitian=True)
        beta = inv @ xty
        sse = float(max(yty - beta @ xty, 0.0))
        mean = full[0, pi] / ni if ni else 0.0  # column 0 is the intercept when there is one
        sst = float(yty - ni * mean * mean) if abs(full[0, 0] - ni) < 1e-9 * max(ni, 1) else float(yty)
        dof = ni - m
        s2 = sse / dof if dof > 0 else np.nan
        k1 = m + 1
        ll = -0.5 * ni * (np.log(2 * np.pi * max(sse, 1e-300) / ni) + 1) if ni else np.nan
        base = ni * np.log(max(sse, 1e-300) / ni) if ni else np.nan
        aic = base + 2 * k1
        aicc = aic + 2 * k1 * (k1 + 1) / (ni - k1 - 1) if ni - k1 - 1 > 0 else np.nan
        bic = aic + k1 * (np.log(ni) - 2) if ni else np.nan
        r2 = 1 - sse / sst if sst > 0 else np.nan
        adj = 1 - (1 - r2) * (ni - 1) / dof if dof > 0 else np.nan
        rows.append((beta, np.sqrt(np.maximum(np.diag(inv) * s2, 0)) if dof > 0 else np.full(m, np.nan),
                     inv.ravel(), sse, sst, r2, adj, s2, ll, aic, aicc, bic))
    return pd.DataFrame(rows, columns=["beta", "se", "xtx_inv", "sse", "sst", "r2", "adj_r2", "sigma2", "loglik",
                                       "aic", "aicc", "bic"])


def solve(grams: DataFrame, keep: Column | None = None) -> DataFrame:
    """Solve each row's normal equations; ``keep`` selects predictor positions."""
    keep = keep if keep is not None else F.lit(None).cast("array<int>")
    fit = grams.withColumn("_f", pandas_udf(_solve, _FIT)("p", "n", "g", keep))
    return fit.select(*[c for c in grams.columns if c != "g"], "_f.*")
