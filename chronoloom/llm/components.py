"""Connected components of an edge table by hooking to the smallest neighbour and shortening paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges``.

    Each round maps every label to its smallest neighbour, follows that map
    twice more, and keeps only the edges between labels that still differ.  A
    label with very many edges is a partial minimum and a splittable join.
    """
    links = written(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y").distinct(), "links")
    mapping = links.sparkSession.createDataFrame([], "node long, component long")
    first = True
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        to = written(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("to")), "hooks")
        for _ in range(2):
            step = to.select(F.col("x").alias("to"), F.col("to").alias("far"))
            to = to.join(step, "to", "left").select("x", F.coalesce("far", "to").alias("to"))
        to = written(to, "labels")
        if first:
            mapping, first = to.select(F.col("x").alias("node"), F.col("to").alias("component")), False
        else:
            mapping = written(mapping.join(to.withColumnRenamed("x", "component"), "component", "left")
                              .select("node", F.coalesce("to", "component").alias("component")), "components")
        x, y = to.select("x", F.col("to").alias("tx")), to.select(F.col("x").alias("y"), F.col("to").alias("ty"))
        links = written(links.join(x, "x").join(y, "y").where("tx <> ty")
                        .select(F.least("tx", "ty").alias("x"), F.greatest("tx", "ty").alias("y")).distinct(), "links")
    return mapping
