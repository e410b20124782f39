"""Hierarchies and groups of series.

A structure is a list of factors; a factor is a list of columns from parent to
child.  ``[["region", "nation"]]`` is nested, ``[["a"], ["b"]]`` crossed,
``[["region", "nation"], ["segment"]]`` mixed.  Margin rows carry NULL keys and
a true ``is_agg_<key>`` flag, so a real NULL key is never taken for a margin.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

Structure = list[list[str]]


def structure_keys(structure: Structure) -> list[str]:
    return [k for factor in structure for k in factor]


def levels(structure: Structure) -> list[list[str]]:
    """Key sets of every aggregation level, total first."""
    prefixes = [[factor[:i] for i in range(len(factor) + 1)] for factor in structure]
    return [[k for part in combo for k in part] for combo in product(*prefixes)]


def flags(structure: Structure) -> list[str]:
    return [f"is_agg_{k}" for k in structure_keys(structure)]


def aggregate_key(df: DataFrame, structure: Structure, by: list[str], aggs: list[Column],
                  only: list[list[str]] | None = None) -> DataFrame:
    """All levels of the hierarchy inside each value of ``by``.

    The frame should already be reduced to leaf rows: the grouping sets copy
    every input row once per level before the (map-side) partial sums.
    """
    keys = structure_keys(structure)
    sets = [[*by, *s] for s in (only or levels(structure))]
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *by, *keys)
    return grouped.agg(*[(F.grouping(k) == 1).alias(f"is_agg_{k}") for k in keys], *aggs)


MARGIN = "<aggregated>"


def label_margins(df: DataFrame, structure: Structure) -> DataFrame:
    """Put a text label in margin keys, so that nodes can be series keys.

    NULL keys never meet in an equi-join; the flags stay and keep a real value
    with the same text distinct.
    """
    return df.withColumns({k: F.when(F.col(f"is_agg_{k}"), F.lit(MARGIN)).otherwise(F.col(k).cast("string"))
                           for k in structure_keys(structure)})


def null_margins(df: DataFrame, structure: Structure) -> DataFrame:
    """Back to NULL margin keys."""
    return df.withColumns({k: F.when(~F.col(f"is_agg_{k}"), F.col(k)) for k in structure_keys(structure)})


def at_level(df: DataFrame, structure: Structure, present: list[str]) -> DataFrame:
    """Rows of one level: listed keys present, all others aggregated."""
    for k in structure_keys(structure):
        flag = F.col(f"is_agg_{k}")
        df = df.where(~flag if k in present else flag)
    return df


def node_id(structure: Structure) -> Column:
    """Text identity of a node, distinct for margins and NULL keys."""
    return F.concat_ws("|", *[
        F.when(F.col(f"is_agg_{k}"), F.lit("*"))
         .when(F.col(k).isNull(), F.lit("?"))
         .otherwise(F.concat(F.lit("="), F.col(k).cast("string"))) for k in structure_keys(structure)])


def ancestors(leaves: DataFrame, structure: Structure) -> DataFrame:
    """Each leaf row once per level it belongs to, keys masked to the node.

    The number of copies is the number of levels, fixed by the structure.
    """
    keys = structure_keys(structure)
    cells = F.array(*[F.struct(
        *[(F.col(k) if k in s else F.lit(None).cast(leaves.schema[k].dataType)).alias(k) for k in keys],
        *[F.lit(k not in s).alias(f"is_agg_{k}") for k in keys]) for s in levels(structure)])
    return leaves.withColumn("_n", F.explode(cells))
