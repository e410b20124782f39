"""Working with forecast tables: intervals, back-transforms, combinations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chronoloom.functions.special import level_z
from chronoloom.functions.transforms import Transform


def hilo(fc: DataFrame, levels=(80, 95), transform: Transform | None = None, mean: str = "mean",
         sigma: str = "sigma") -> DataFrame:
    """Add ``lo80, hi80, ...``; quantiles pass through the inverse transform."""
    cols = {}
    for level in levels:
        z = level_z(level)
        lo, hi = F.col(mean) - z * F.col(sigma), F.col(mean) + z * F.col(sigma)
        if transform is not None:
            lo, hi = transform.inverse(lo), transform.inverse(hi)
        cols[f"lo{level:g}"], cols[f"hi{level:g}"] = lo, hi
    return fc.withColumns(cols)


def back_transform(fc: DataFrame, transform: Transform, levels=(80, 95)) -> DataFrame:
    """Model-scale (mean, sigma) to response-scale mean, median, intervals."""
    out = hilo(fc, levels, transform)
    mu, s2 = F.col("mean"), F.col("sigma") * F.col("sigma")
    return out.withColumns({"median": transform.median(mu), "mean": transform.mean(mu, s2)})


def combination(fc: DataFrame, by: list[str], name: str = "combination") -> DataFrame:
    """Equal-weight mean of the models' point forecasts."""
    return fc.groupBy(*by).agg(F.avg("mean").alias("mean")).withColumn("model", F.lit(name))


def sum_distributions(fc: DataFrame, by: list[str]) -> DataFrame:
    """Sum of independent normal forecasts."""
    return fc.groupBy(*by).agg(F.sum("mean").alias("mean"),
                               F.sqrt(F.sum(F.col("sigma") * F.col("sigma"))).alias("sigma"))


def sample_distribution(paths: DataFrame, by: list[str], value: str = "sim", levels=(80, 95)) -> DataFrame:
    """Mean and intervals of simulated values per group.

    A group holds one value per replicate, a number the caller chose.
    """
    probs = {}
    for level in levels:
        probs[f"lo{level:g}"], probs[f"hi{level:g}"] = 0.5 - level / 200, 0.5 + level / 200
    return paths.groupBy(*by).agg(
        F.avg(value).alias("mean"),
        *[F.percentile(value, F.lit(p)).alias(name) for name, p in probs.items()])
