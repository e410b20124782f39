"""Column and reshape verbs that add something to the DataFrame API."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def select_matching(df: DataFrame, pattern: str, always: list[str] = ()) -> DataFrame:
    """Columns whose name matches, after the ``always`` ones."""
    return df.select(*always, *[c for c in df.columns if re.search(pattern, c) and c not in always])


def select_range(df: DataFrame, first: str, last: str) -> DataFrame:
    cols = df.columns
    return df.select(*cols[cols.index(first):cols.index(last) + 1])


def relocate(df: DataFrame, *front: str) -> DataFrame:
    return df.select(*front, *[c for c in df.columns if c not in front])


def recode(col: Column, mapping: dict[str, str]) -> Column:
    """Map listed values, keep the others."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(pairs[col], col)


def pivot_longer(df: DataFrame, ids: list[str], cols: list[str], names_to: str = "name",
                 values_to: str = "value") -> DataFrame:
    return df.unpivot(ids, cols, names_to, values_to)


def pivot_wider(df: DataFrame, ids: list[str], names_from: str, values: list, values_from: str) -> DataFrame:
    """One column per declared value; one aggregation, no distinct scan."""
    picks = [F.max(F.when(F.col(names_from) == v, F.col(values_from))).alias(str(v)) for v in values]
    return df.groupBy(*ids).agg(*picks)


def union_all(frames: dict[str, DataFrame], id_col: str = "id") -> DataFrame:
    """Stack named frames by column name with a label column."""
    out = None
    for label, df in frames.items():
        part = df.select(F.lit(label).alias(id_col), *df.columns)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    return [c for c in a.columns if c in b.columns]


def natural_join(a: DataFrame, b: DataFrame, how: str, null_safe: bool = True) -> DataFrame:
    """Join on all shared columns; NULL keys match when ``null_safe``."""
    on = common_columns(a, b)
    if not null_safe:
        return a.join(b, on, how)
    b2 = b.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in b.columns if c not in on])
    cond = None
    for c in on:
        test = a[c].eqNullSafe(b2[f"_r_{c}"])
        cond = test if cond is None else cond & test
    out = a.join(b2, cond, how)
    if how in ("left_semi", "left_anti"):
        return out
    keep = [F.coalesce(F.col(f"_r_{c}"), F.col(c)).alias(c) if how in ("right", "full", "outer") else F.col(c)
            for c in on]
    return out.select(*keep, *[c for c in a.columns if c not in on], *[c for c in b.columns if c not in on])


def filter_group_extreme(df: DataFrame, keys: list[str], by: Column, value: str, largest: bool = True) -> DataFrame:
    """Rows that hold the largest (smallest) ``value`` of their group; ties stay.

    An aggregate joined back, so a hot group is reduced before the shuffle.
    """
    base = df.withColumn("_g", by)
    best = base.groupBy(*keys, "_g").agg((F.max if largest else F.min)(value).alias("_best"))
    return base.join(best, [*keys, "_g"]).where(F.col(value) == F.col("_best")).drop("_g", "_best")
