"""Re-sampling an unbounded source with the same verb as finished tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Window lengths of the units a stream can be re-sampled to.
WINDOWS = {"minute": "1 minute", "5min": "5 minutes", "15min": "15 minutes", "30min": "30 minutes",
           "hour": "1 hour", "day": "1 day", "week": "7 days"}


def index_by_stream(df: DataFrame, keys: list[str], ts: str, unit: str, aggs: list[Column],
                    late: str = "1 hour", index: str = "index") -> DataFrame:
    """Tumbling re-sample per key; a period is final ``late`` after its end.

    Partial sums are kept per (keys, period) in the state store and dropped
    once the watermark passes, so state is bounded by the open periods.
    """
    stamped = df.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    start = {"week": "4 days"}.get(unit)  # weeks start on Monday
    win = F.window("_ts", WINDOWS[unit], WINDOWS[unit], start) if start else F.window("_ts", WINDOWS[unit])
    out = stamped.groupBy(*keys, win.alias("_w")).agg(*aggs)
    return out.select(*keys, F.col("_w.start").cast("timestamp_ntz").alias(index), *[c for c in out.columns if c not in (*keys, "_w")])
