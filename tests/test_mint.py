"""Matrix-free reconciliation against dense matrices."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_operators import STRUCT, coherent, hier

from chronoloom.operators import hierarchy as hy, mint, packed, reconcile as rc

ID = ["a", "b", "c", *hy.flags(STRUCT)]


def residuals(spark, fc, periods, seed=3, gaps=False):
    """Residuals of every node, not coherent; with ``gaps`` one leaf starts late."""
    nodes = fc.select(*ID).distinct().orderBy(*ID).toPandas()
    rng = np.random.default_rng(seed)
    e = rng.normal(size=(len(nodes), 3)) @ rng.normal(size=(3, periods)) + rng.normal(size=(len(nodes), periods))
    rows = [(*nodes.iloc[i, :3], *map(bool, nodes.iloc[i, 3:]), 100 + t, None if gaps and i == 7 and t < periods // 2 else float(e[i, t])) for i in range(len(nodes)) for t in range(periods)]
    return spark.createDataFrame(rows, "a string, b string, c string, is_agg_a boolean, is_agg_b boolean, is_agg_c boolean, t long, resid double")


def dense(fc, resid=None):
    """(mean, sigma) by (node, t) from matrices."""
    p = fc.toPandas()
    p["node"] = list(zip(*[p[c] for c in ID]))
    nodes = sorted(p.node.unique())
    leaves = [n for n in nodes if not any(n[3:])]
    s = np.array([[float(all(n[3 + k] or n[k] == l[k] for k in range(3))) for l in leaves] for n in nodes])
    lam = 1.0
    if resid is None:
        w = np.eye(len(nodes))
    else:
        r = resid.toPandas()
        r["node"] = list(zip(*[r[c] for c in ID]))
        e = r.pivot(index="t", columns="node", values="resid")[nodes].to_numpy(float)
        n, own = len(e), np.isfinite(e).sum(axis=0)
        e = np.nan_to_num(e) / np.sqrt(own)
        cov = e.T @ e
        x = e / np.sqrt(np.diag(cov)) * np.sqrt(n)
        corr, spread = x.T @ x / n, ((x * x).T @ (x * x) - (x.T @ x) ** 2 / n) / (n * (n - 1))
        off = ~np.eye(len(nodes), dtype=bool)
        lam = np.clip(spread[off].sum() / (corr[off] ** 2).sum(), 0, 1)
        w = lam * np.diag(np.diag(cov)) + (1 - lam) * cov
    m = s @ np.linalg.solve(s.T @ np.linalg.solve(w, s), np.linalg.solve(w, s).T)
    sd = np.sqrt(np.diag(w))
    out = {}
    for t, g in p.groupby("t"):
        g = g.set_index("node").loc[nodes]
        k = m * (g["sigma"].to_numpy() / sd)
        for node, mean, var in zip(nodes, m @ g["mean"].to_numpy(), np.diag(k @ w @ k.T)):
            out[node, t] = (mean, np.sqrt(var))
    return out, lam


def test_shared_solve_equals_one_task(spark, monkeypatch):
    """The steps over many tasks give what one task gives."""
    rng = np.random.default_rng(4)
    b = rng.normal(size=(6, 9)) * (rng.random((6, 9)) < .6) + np.eye(6, 9)
    r = rng.normal(size=(6, 3))
    r[:, 1] = 0
    entries = spark.createDataFrame([(f"r{i}", f"c{j}", float(b[i, j])) for i in range(6) for j in range(9) if b[i, j]], "row string, col string, v double").cache()
    rhs = spark.createDataFrame([(f"r{i}", r[i].tolist()) for i in range(6)], packed.VECTORS)
    want = np.linalg.solve(b @ b.T, r)
    for small in (packed.SMALL, 0):
        monkeypatch.setattr(packed, "SMALL", small)
        got = {x.id: x.x for x in packed.solve_gram(entries, rhs, 3).collect()}
        assert np.allclose([got[f"r{i}"] for i in range(6)], want, atol=1e-8)


@pytest.mark.parametrize("case", ["ols", "mint", "gaps"])
def test_equals_dense_matrices(spark, monkeypatch, case):
    monkeypatch.setattr(mint, "WIDTH", 15)  # several solves
    monkeypatch.setattr(mint, "SPAN", 7)    # several blocks of periods
    fc = hier(spark).where("t <= 2").withColumn("sigma", 1.0 + F.abs(F.col("mean")) / 10 + F.col("t")).cache()
    resid = None if case == "ols" else residuals(spark, fc, 30, gaps=case == "gaps")
    want, lam = dense(fc, resid)
    if resid is not None:
        e, var, n = mint.scaled_residuals(resid, STRUCT, "t")
        assert mint.shrinkage(e, var, n) == pytest.approx(lam, rel=1e-9)
    out = rc.min_trace(fc, STRUCT, ["t"], "ols" if resid is None else "mint_shrink", resid)
    assert set(out.columns) == set(fc.columns)
    rows = out.collect()
    assert len(rows) == len(want)
    for r in rows:
        mean, sigma = want[tuple(r[c] for c in ID), r["t"]]
        assert r["mean"] == pytest.approx(mean, rel=1e-6, abs=1e-8) and r["sigma"] == pytest.approx(sigma, rel=1e-6)


def test_two_thousand_nodes(spark):
    rng = np.random.default_rng(1)
    leaves = pd.DataFrame([(f"g{i}", f"g{i}x{j}", float(rng.gamma(3))) for i in range(60) for j in range(33)], columns=["g", "x", "y"])
    one = [["g", "x"]]
    nodes = hy.label_margins(hy.aggregate_key(spark.createDataFrame(leaves).withColumn("t", F.lit(1)), one, ["t"], [F.sum("y").alias("y")]), one)
    fc = nodes.withColumn("mean", F.col("y") + F.pmod(F.hash("g", "x"), F.lit(100)) / 100.0).drop("y").cache()
    assert fc.count() == 2_041
    got = rc.min_trace(fc, one, ["t"], "ols").toPandas()
    # least squares of a nested hierarchy in closed form: leaf + its group's share of the gap + ...; checked by coherence and orthogonality
    leaf = got[~(got.is_agg_g | got.is_agg_x)]
    base = fc.toPandas().merge(got, on=["g", "x", "is_agg_g", "is_agg_x"], suffixes=("", "_new"))
    groups = leaf.groupby("g")["mean"].sum()
    for r in got[got.is_agg_x & ~got.is_agg_g].itertuples():
        assert r.mean == pytest.approx(groups[r.g], rel=1e-9)
    base["gap"] = base["mean"] - base["mean_new"]
    top = base[base.is_agg_g].gap.sum()
    by_group = base[base.is_agg_x & ~base.is_agg_g].set_index("g").gap
    rest = base[~base.is_agg_x]
    assert np.abs(rest.gap.to_numpy() + by_group[rest.g].to_numpy() + top).max() < 1e-7  # S'(y - y~) = 0


def test_edges(spark):
    fc = hier(spark).where("t = 1").withColumn("sigma", F.lit(1.0)).cache()
    assert rc.min_trace(fc.limit(0), STRUCT, ["t"], "ols").count() == 0
    with pytest.raises(ValueError):
        rc.min_trace(fc.where("NOT (is_agg_a AND is_agg_c)").unionByName(fc.where("is_agg_a").withColumn("t", F.lit(2).cast("long"))), STRUCT, ["t"], "ols")
    with pytest.raises(ValueError):
        rc.min_trace(fc, STRUCT, ["t"], "mint_shrink")
    # forecasts that are coherent already stay
    base = rc.bottom_up(fc.drop("sigma"), STRUCT, ["t"])
    base = hy.label_margins(base, STRUCT)
    again = rc.min_trace(base, STRUCT, ["t"], "mint_shrink", residuals(spark, fc, 12))
    coherent(again)
    both = base.withColumnRenamed("mean", "m1").join(again, ["t", *ID])
    assert both.count() == fc.count() and both.where(F.abs(F.col("m1") - F.col("mean")) > 1e-8).count() == 0


def test_packed_sums(spark):
    rng = np.random.default_rng(0)
    rows = [(str(rng.integers(0, 5)), rng.normal(size=3).tolist()) for _ in range(400)] + [("hot", [1.0, 0.0, 2.0])] * 500
    got = {r.id: r.x for r in packed.add_up(spark.createDataFrame(rows, packed.VECTORS).repartition(6), 3).collect()}
    for k in {r[0] for r in rows}:
        assert np.allclose(got[k], np.sum([x for i, x in rows if i == k], axis=0))
    assert packed.add_up(spark.createDataFrame([], packed.VECTORS), 3).count() == 0
