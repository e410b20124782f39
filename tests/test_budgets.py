"""Hot groups: quantiles with a row budget, row numbers with all rows in one hour."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.operators import quantile
from chronoloom.operators.blocks import row_numbers


@pytest.mark.parametrize("budget", [100, 1_000_000])
def test_quantiles_of_one_group_within_a_budget(spark, monkeypatch, budget):
    monkeypatch.setattr(quantile, "BUDGET", budget)
    rng = np.random.default_rng(1)
    own = {"a": rng.normal(size=20_000), "b": np.r_[np.zeros(5_000), rng.exponential(size=500)], "c": np.array([3.0]), "d": rng.integers(0, 40, 900).astype(float)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in own.items() for v in vs], "k string, v double").repartition(5)
    probs = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "high": 0.987, "top": 1.0}
    for r in quantile.group_quantiles(df, ["k"], "v", probs).collect():
        assert np.allclose([r[n] for n in probs], np.quantile(own[r.k], list(probs.values())))
    one = quantile.group_quantiles(df, [], "v", {"mid": 0.5}).first()
    assert np.isclose(one.mid, np.quantile(np.concatenate(list(own.values())), 0.5))
    assert quantile.group_quantiles(df.limit(0), ["k"], "v", probs).count() == 0


@pytest.mark.parametrize("descending", [False, True])
def test_row_numbers_with_all_rows_in_one_hour(spark, descending):
    rng = np.random.default_rng(2)
    n = 3_000
    rows = [("hot" if i % 3 else None if i % 2 else f"k{i % 50}", int(v)) for i, v in enumerate(rng.permutation(n))]
    df = spark.createDataFrame(rows, "k string, second long").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several tasks for a small table
    out = row_numbers(df, ["k"], F.col("second"), name="rn", descending=descending).cache()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert out.columns == ["k", "second", "rn"]
    got = {(r.k, r.second): r.rn for r in out.collect()}
    assert len(got) == n
    for k in {k for k, _ in rows}:
        own = sorted((s for g, s in rows if g == k), reverse=descending)
        assert [got[k, s] for s in own] == list(range(1, len(own) + 1))
    alone = row_numbers(df.select("second"), [], F.col("second"), name="rn")
    assert alone.where("rn <> second + 1").count() == 0 and row_numbers(df.limit(0), ["k"], F.col("second")).count() == 0
