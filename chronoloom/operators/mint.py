"""Trace-minimising reconciliation for hierarchies of any size.

With C the constraints (a node above the leaves less its leaves) and W the
covariance of base errors, coherent forecasts are
y - W C' (C W C')^-1 C y.  W = F F' is never formed: F holds the residual rows,
one column a period, and the scaled diagonal.  C W C' = (C F)(C F)' is solved by
conjugate gradients for all steps at once.  Variances come from the same solve
with one right-hand side for each node.  Nodes stay in DataFrames throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from chronoloom.operators.blocks import cut_lineage
from chronoloom.operators.hierarchy import Structure, ancestors, at_level, flags, node_id, structure_keys
from chronoloom.operators.packed import VECTORS, add_up, lists, matrix, multiply, pack, solve_gram

#: Right-hand sides of one solve, and periods of one block of the Gram matrix.
WIDTH, SPAN = 512, 256


def _ancestor_id(structure: Structure, name: str):
    return F.concat_ws("|", *[
        F.when(F.col(f"{name}.is_agg_{k}"), F.lit("*")).when(F.col(f"{name}.{k}").isNull(), F.lit("?"))
         .otherwise(F.concat(F.lit("="), F.col(f"{name}.{k}").cast("string"))) for k in structure_keys(structure)])


def constraints(nodes: DataFrame, structure: Structure) -> DataFrame:
    """(agg, node, v): entries of C; ``nodes`` has the keys, flags and ``_node``."""
    leaves = at_level(nodes, structure, structure_keys(structure)).select(*structure_keys(structure), "_node")
    spread = ancestors(leaves, structure).select(_ancestor_id(structure, "_n").alias("agg"), F.col("_node").alias("node")).where("agg <> node")
    above = nodes.where(" OR ".join(flags(structure))).select(F.col("_node").alias("agg"), F.col("_node").alias("node"), F.lit(1.0).alias("v"))
    return above.unionByName(spread.join(above.select("agg"), "agg").withColumn("v", F.lit(-1.0)))


def scaled_residuals(resid: DataFrame, structure: Structure, t: str) -> tuple[DataFrame, DataFrame, int]:
    """(node, t, e), (node, var) and the number of periods; e is the residual over the root of the node's own count.

    Sums of products of e over the common periods of two nodes are their
    covariance where both are complete.  A node that starts late keeps its own
    variance, costs no other node a period, and W stays positive.
    """
    rows = resid.where(F.col("resid").isNotNull()).select(node_id(structure).alias("node"), F.col(t).cast("long").alias("t"), F.col("resid").cast("double").alias("e"))
    rows = cut_lineage(rows)
    own = rows.groupBy("node").agg(F.count(F.lit(1)).alias("_n"), F.avg(F.col("e") * F.col("e")).alias("var"))
    own = own.select("node", "_n", F.when(F.col("var") > 0, F.col("var")).otherwise(1e-12).alias("var"))
    periods = rows.select("t").distinct().count()
    if periods < 2:
        raise ValueError("too few periods with residuals")
    e = rows.join(own.select("node", "_n"), "node").select("node", "t", (F.col("e") / F.sqrt("_n")).alias("e"))
    return cut_lineage(e), own.select("node", "var"), periods


def _gram_square(x: DataFrame, width_from: int) -> float:
    """Sum of squares of X X' over all pairs of periods, X = (node, t, x) as node columns: in blocks of SPAN x SPAN periods."""
    cell = F.col("t") - F.lit(width_from)
    packed = pack(x.select(F.concat_ws("\t", F.floor(cell / SPAN).cast("string"), "node").alias("id"), F.pmod(cell, F.lit(SPAN)).alias("i"), F.col("x").alias("v")), SPAN)
    packed = cut_lineage(packed.select(F.split("id", "\t")[0].cast("long").alias("blk"), F.substring_index("id", "\t", -1).alias("node"), "x"))
    other = packed.select("node", F.col("blk").alias("blk2"), F.col("x").alias("x2"))
    salt = int(x.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = packed.join(other, "node").where("blk <= blk2").select(
        F.concat_ws("-", F.col("blk").cast("string"), F.col("blk2").cast("string")).alias("id"), F.pmod(F.xxhash64("node"), F.lit(salt)).alias("salt"), "x", "x2")

    def products(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([last]), lists(held.reshape(1, -1))], ["id", "x"])

        for part in parts:
            ids = np.array(part.column("id").to_pylist(), object)
            a, b = matrix(part.column("x"), SPAN), matrix(part.column("x2"), SPAN)
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)] if len(ids) else [0]
            for lo, hi in zip(cuts, cuts[1:]):
                if ids[lo] != last:
                    if last is not None:
                        yield out()
                    last, held = ids[lo], np.zeros((SPAN, SPAN))
                held += a[lo:hi].T @ b[lo:hi]
        if last is not None:
            yield out()

    partial = pairs.repartition("id", "salt").sortWithinPartitions("id").select("id", "x", "x2").mapInArrow(products, VECTORS)
    blocks = add_up(partial, SPAN * SPAN)
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v) * F.when(F.split("id", "-")[0] == F.split("id", "-")[1], 1).otherwise(2)
    return blocks.agg(F.sum(square)).first()[0] or 0.0


def shrinkage(e: DataFrame, var: DataFrame, periods: int) -> float:
    """Intensity from the spread of all correlations, without a node x node matrix.

    With X the standardised residuals, the sum of squared correlations over all
    pairs of nodes is the sum of squares of X X' over pairs of periods, and the
    sum of products of squares is a sum over periods.
    """
    x = cut_lineage(e.join(var, "node").select("node", "t", (F.col("e") / F.sqrt("var") * float(np.sqrt(periods))).alias("x")))
    square = _gram_square(x, x.agg(F.min("t")).first()[0])
    by_period = x.groupBy("t").agg(F.sum(F.col("x") * F.col("x")).alias("q")).agg(F.sum(F.col("q") * F.col("q"))).first()[0]
    own, fourth = x.groupBy("node").agg(F.sum(F.col("x") * F.col("x")).alias("q"), F.sum(F.pow("x", F.lit(4))).alias("f")).agg(
        F.sum(F.col("q") * F.col("q")), F.sum("f")).first()
    off = square - own
    spread = (by_period - fourth - off / periods) / (periods * (periods - 1))
    return float(np.clip(spread / max(off / periods ** 2, 1e-300), 0.0, 1.0))


def factor(nodes: DataFrame, structure: Structure, resid: DataFrame | None, t: str) -> tuple[DataFrame, DataFrame]:
    """Entries (node, col, v) of F with W = F F', and (node, sd): unit for least squares, shrunk with residuals."""
    own = nodes.select(F.col("_node").alias("node"))
    if resid is None:
        return own.select("node", F.concat(F.lit("n|"), "node").alias("col"), F.lit(1.0).alias("v")), own.withColumn("sd", F.lit(1.0))
    e, var, periods = scaled_residuals(resid, structure, t)
    lam = shrinkage(e, var, periods)
    var = own.join(var, "node", "left").select("node", F.coalesce("var", F.lit(1e-12)).alias("var"))  # no residual at all: as good as exact
    rows = e.join(own, "node").select("node", F.concat(F.lit("t|"), F.col("t").cast("string")).alias("col"), (F.col("e") * float(np.sqrt(1 - lam))).alias("v"))
    diagonal = var.select("node", F.concat(F.lit("n|"), "node").alias("col"), F.sqrt(F.col("var") * lam).alias("v"))
    return rows.unionByName(diagonal).where("v <> 0"), var.select("node", F.sqrt("var").alias("sd"))


def _sigmas(structure: Structure, nodes: DataFrame, f: DataFrame, b: DataFrame, c: DataFrame, sd: DataFrame, sigma: DataFrame, steps: int) -> DataFrame:
    """(node, i, sigma): diagonal of M S_i M' for every step, S_i the correlations of W scaled by the step's own sigmas.

    M = I - N C with N' = (C W C')^-1 C W, one right-hand side for each node,
    WIDTH of them at a time.  S_i = G G' with G = diag(sigma_i / sd) F, so the
    diagonal is the sum of squares of G - N (C G) over its columns.
    """
    numbered = cut_lineage(nodes.select(F.col("_node").alias("node"), (F.row_number().over(Window.orderBy("_node")) - 1).alias("n")))  # one row per node
    total = numbered.count()
    ratio = sigma.join(sd, "node").select("node", "i", (F.col("sigma") / F.col("sd")).alias("k"))
    g = cut_lineage(f.join(ratio, "node").select("node", "i", F.concat_ws("\t", F.col("i").cast("string"), "col").alias("col"), (F.col("v") * F.col("k")).alias("v")))
    cg = cut_lineage(c.join(g, "node").groupBy("agg", "col").agg(F.sum(c["v"] * g["v"]).alias("v")))
    own = g.groupBy("node", "i").agg(F.sum(F.col("v") * F.col("v")).alias("s"))
    out = None
    for low in range(0, total, WIDTH):
        width = min(WIDTH, total - low)
        part = numbered.where((F.col("n") >= low) & (F.col("n") < low + width)).select("node", (F.col("n") - low).alias("at"))
        columns = pack(f.join(part, "node").select(F.col("col").alias("id"), F.col("at").alias("i"), "v"), width)
        rhs = cut_lineage(multiply(b, "col", "row", columns, width))
        n = cut_lineage(solve_gram(b, rhs, width))  # N' in rows of aggregates
        z = cut_lineage(multiply(cg, "agg", "col", n, width))  # (C G)' N'
        squares = add_up(z.select(F.split("id", "\t")[0].alias("id"), F.transform("x", lambda v: v * v).alias("x")), width)
        squares = squares.select(F.col("id").cast("int").alias("i"), F.posexplode("x").alias("at", "z"))
        cross = g.join(part, "node").join(z.withColumnRenamed("id", "col"), "col").groupBy("at", "i").agg(
            F.sum(F.col("v") * F.element_at("x", F.col("at").cast("int") + 1)).alias("c"))
        both = part.join(squares, "at").join(cross, ["at", "i"], "left").join(own, ["node", "i"], "left")
        both = cut_lineage(both.select("node", "i", F.sqrt(F.greatest(F.coalesce("s", F.lit(0.0)) - 2 * F.coalesce("c", F.lit(0.0)) + F.col("z"), F.lit(0.0))).alias("sigma")))
        out = both if out is None else out.unionByName(both)
    return out


def min_trace(fc: DataFrame, structure: Structure, by: list[str], resid: DataFrame | None = None, t: str = "t") -> DataFrame:
    """Coherent means (and sigmas, where ``fc`` has them); least squares without ``resid``, shrunk covariance with it.

    ``by`` names the steps (model, period); every node needs a value in every
    one of them.  The exact sigmas take a right-hand side for each node, so
    they cost the square of the number of nodes; means alone do not.  An empty frame gives no rows.
    """
    keys, marks = structure_keys(structure), flags(structure)
    sigma = "sigma" in fc.columns
    base = cut_lineage(fc.withColumn("_node", node_id(structure)))
    steps = base.select(*by).distinct().orderBy(*by).collect()  # one row per step
    nodes = cut_lineage(base.select(*keys, *marks, "_node").distinct())
    if not steps:
        return fc.select(*by, *keys, *marks, "mean", *(["sigma"] if sigma else [])).limit(0)
    width = len(steps)
    places = fc.sparkSession.createDataFrame([(*r, i) for i, r in enumerate(steps)], StructType([*base.select(*by).schema.fields, StructField("_i", IntegerType())]))
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"p.{c}")) for c in by]
    on = same[0]
    for s in same[1:]:
        on = on & s
    base = cut_lineage(base.alias("b").join(F.broadcast(places.alias("p")), on).select("b.*", "p._i"))
    bad = base.groupBy("_node").agg(F.countDistinct("_i").alias("n"), F.count(F.lit(1)).alias("all"), F.count("mean").alias("known")).where(
        (F.col("n") < width) | (F.col("all") > width) | (F.col("known") < F.col("all"))).take(1)
    if bad:
        raise ValueError(f"every node needs one value in every period: {bad[0]['_node']}")
    y = cut_lineage(pack(base.select(F.col("_node").alias("id"), F.col("_i").alias("i"), F.col("mean").alias("v")), width))
    c = cut_lineage(constraints(nodes, structure))
    f, sd = factor(nodes, structure, resid, t)
    f = cut_lineage(f)
    b = cut_lineage(c.join(f, "node").groupBy(F.col("agg").alias("row"), "col").agg(F.sum(c["v"] * f["v"]).alias("v")).where("v <> 0"))
    x = solve_gram(b, cut_lineage(multiply(c, "node", "agg", y, width)), width)
    change = multiply(f, "col", "node", multiply(b, "row", "col", x, width), width)
    leaves = at_level(nodes, structure, keys).select(F.col("_node").alias("id"))
    fixed = cut_lineage(y.join(leaves, "id").join(change.select("id", F.col("x").alias("d")), "id", "left").select(
        "id", F.when(F.col("d").isNull(), F.col("x")).otherwise(F.zip_with("x", "d", lambda u, v: u - v)).alias("x")))
    # sums of the leaves are coherent whatever the last digits of the solution
    above = multiply(c.where("v < 0").withColumn("v", -F.col("v")), "node", "agg", fixed, width)
    means = fixed.unionByName(above).select(F.col("id").alias("_node"), F.posexplode("x").alias("_i", "mean"))
    if sigma:
        own = base.select(F.col("_node").alias("node"), F.col("_i").alias("i"), F.coalesce("sigma", F.lit(0.0)).alias("sigma"))
        found = _sigmas(structure, nodes, f, b, c, sd, own, width)
        means = means.join(found.select(F.col("node").alias("_node"), F.col("i").alias("_i"), "sigma"), ["_node", "_i"])
    out = means.join(nodes, "_node").join(F.broadcast(places), "_i")
    return out.select(*by, *keys, *marks, "mean", *(["sigma"] if sigma else []))
