"""Rolling-origin evaluation without building the folds.

For the closed-form models every fold's fit is a running total, so one ordered
pass gives all folds; memory and work grow with rows, not with rows squared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chronoloom.operators.blocks import lag_columns, row_numbers, running_sums, BLOCK
from chronoloom.series import SeriesSpec

CLOSED_FORM = ("mean", "naive", "drift")


def cross_validate(df: DataFrame, spec: SeriesSpec, y: str, init: int, step: int = 1, h: int = 1,
                   models=CLOSED_FORM) -> DataFrame:
    """Errors of every fold: (keys, model, fold, t, h, mean, y, error).

    Fold i trains on the first ``init + (i-1)*step`` rows.
    """
    base = row_numbers(df.select(*spec.by, spec.t, y), spec.by, F.col(spec.t), F.floor(F.col(spec.t) / BLOCK), "_i")
    base = running_sums(base, spec.by, spec.t, {"_sum": F.col(y)})
    first = df.groupBy(*spec.by).agg(F.min_by(y, spec.t).alias("_y1"))
    base = base.join(first, spec.by)
    base = lag_columns(base, spec, {f"_a{k}": (y, -k) for k in range(1, h + 1)})
    base = base.where((F.col("_i") >= init) & ((F.col("_i") - init) % step == 0))
    slope = (F.col(y) - F.col("_y1")) / F.nullif(F.col("_i") - 1, F.lit(0))
    point = {"mean": lambda k: F.col("_sum") / F.col("_i"), "naive": lambda k: F.col(y),
             "drift": lambda k: F.col(y) + k * slope}
    cells = F.array(*[F.struct(F.lit(name).alias("model"), F.lit(k).alias("h"), point[name](k).alias("mean"),
                               F.col(f"_a{k}").alias("actual"))
                      for name in models for k in range(1, h + 1)])
    out = base.withColumn("_c", F.explode(cells)).where(F.col("_c.actual").isNotNull())
    return out.select(*spec.by, "_c.model", (F.floor((F.col("_i") - init) / step) + 1).alias("fold"),
                      (F.col(spec.t) + F.col("_c.h")).alias(spec.t), "_c.h", "_c.mean",
                      F.col("_c.actual").alias(y), (F.col("_c.actual") - F.col("_c.mean")).alias("error"))


def summarise_errors(errors: DataFrame, by: list[str], y: str = "y") -> DataFrame:
    e = F.col("error")
    return errors.groupBy(*by).agg(F.avg(e).alias("me"), F.sqrt(F.avg(e * e)).alias("rmse"),
                                   F.avg(F.abs(e)).alias("mae"), F.count(e).alias("n"))
