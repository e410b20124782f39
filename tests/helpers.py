import numpy as np

from chronoloom.series import SeriesSpec

SPEC = SeriesSpec(("key",), "idx", "int", period=4, gapless=True)


def frame(spark, series: dict, start: int = 1):
    """Rows (key, idx, t, y) from {key: values}."""
    rows = [(k, start + i, start + i, None if v is None or (isinstance(v, float) and np.isnan(v)) else float(v))
            for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "key string, idx long, t long, y double")


def noisy(n, m=4, seed=1, trend=0.1):
    rng = np.random.default_rng(seed)
    return 10 + trend * np.arange(n) + 2 * np.sin(2 * np.pi * np.arange(n) / m) + rng.normal(0, 0.5, n)
