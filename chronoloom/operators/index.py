"""Time-index verbs: gaps, future rows, re-sampling, folds, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chronoloom.functions.calendar import horizon, partial_date, period_number, truncate
from chronoloom.operators.blocks import BLOCK, lag_columns, row_numbers
from chronoloom.series import SeriesSpec


def index_by(df: DataFrame, keys, ts: str, unit: str, aggs: list[Column], index: str = "index") -> DataFrame:
    """Re-sample to a coarser index: one aggregation per (keys, period)."""
    return df.groupBy(*keys, truncate(F.col(ts), unit).alias(index)).agg(*aggs)


def filter_index(df: DataFrame, column: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows from partial date ``start`` through all of ``end`` (both inclusive).

    The bounds are literals on the bare column, so they reach the file scan.
    """
    if start is not None:
        df = df.where(F.col(column) >= F.lit(partial_date(start)[0]))
    if end is not None:
        df = df.where(F.col(column) < F.lit(partial_date(end)[1]))
    return df


def infer_interval(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Smallest step between neighbouring periods of each series."""
    from chronoloom.operators.blocks import windowed
    # the previous row may be many periods back, so look one row back inside a
    # block and compare block edges through their first and last periods
    step = windowed(df.select(*spec.by, spec.t), spec,
                    {"_prev": lambda w: F.lag(spec.t).over(w)})
    inner = step.groupBy(*spec.by).agg(F.min(F.col(spec.t) - F.col("_prev")).alias("_inner"))
    from pyspark.sql import Window
    edges = df.groupBy(*spec.by, F.floor(F.col(spec.t) / BLOCK).alias("_blk")).agg(
        F.min(spec.t).alias("_lo"), F.max(spec.t).alias("_hi"))
    w = Window.partitionBy(*spec.by).orderBy("_blk")
    outer = edges.withColumn("_gap", F.col("_lo") - F.lag("_hi").over(w)).groupBy(*spec.by).agg(
        F.min("_gap").alias("_outer"))
    return inner.join(outer, spec.by).select(
        *spec.by, F.least("_inner", "_outer").alias("interval"))


def spans(df: DataFrame, spec: SeriesSpec, full: bool = False) -> DataFrame:
    """First and last period per key (or the common span of all keys)."""
    own = df.groupBy(*spec.by).agg(F.min(spec.t).alias("_lo"), F.max(spec.t).alias("_hi"))
    if not full:
        return own
    lo, hi = own.agg(F.min("_lo").alias("v")), own.agg(F.max("_hi").alias("v"))
    return own.select(*spec.by, lo.scalar().alias("_lo"), hi.scalar().alias("_hi"))


def fill_gaps(df: DataFrame, spec: SeriesSpec, values: dict | None = None, full: bool = False) -> tuple[DataFrame, SeriesSpec]:
    """Insert a row for every missing period; measures are NULL or ``values``.

    The calendar is exploded block-wise so that a long span is not built in a
    single row, then joined back on (keys, t).
    """
    cal = spans(df, spec, full)
    cal = cal.withColumn("_b", F.explode(F.sequence(F.floor(F.col("_lo") / BLOCK), F.floor(F.col("_hi") / BLOCK))))
    cal = cal.select(*spec.by, F.explode(F.sequence(
        F.greatest("_lo", F.col("_b") * BLOCK), F.least("_hi", (F.col("_b") + 1) * BLOCK - 1))).alias(spec.t))
    measures = [c for c in df.columns if c not in (*spec.keys, spec.index, spec.t)]
    # the calendar is complete, so it can be stacked on the data and reduced by
    # (keys, t) in one exchange instead of a join of two exchanged sides
    stacked = df.select(*spec.by, spec.t, F.lit(1).alias("_real"), *measures).unionByName(
        cal.withColumn("_real", F.lit(0)), allowMissingColumns=True)
    first = [F.max(F.when(F.col("_real") == 1, F.col(c))).alias(c) for c in measures]
    out = stacked.groupBy(*spec.by, spec.t).agg(*first, F.max("_real").alias("_real"))
    if values:
        out = out.withColumns({c: F.when(F.col("_real") == 1, F.col(c)).otherwise(F.lit(v))
                               for c, v in values.items()})
    out = out.withColumn(spec.index, spec.index_expr(F.col(spec.t)))
    return out.select(*spec.by, spec.index, spec.t, *measures), spec.with_(gapless=True)


def new_data(df: DataFrame, spec: SeriesSpec, n: int | str | None = None) -> DataFrame:
    """The next ``n`` index values of each key, with the step number ``h``; ``n`` as in forecasts (steps, "2 weeks", None)."""
    n = horizon(n, spec.unit, spec.period)
    last = df.groupBy(*spec.by).agg(F.max(spec.t).alias("_last"))
    out = last.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(n))))
    t = (F.col("_last") + F.col("h")).cast("long")
    return out.select(*spec.by, spec.index_expr(t).alias(spec.index), t.alias(spec.t), F.col("h").cast("int").alias("h"))


def scenarios(future: DataFrame, named: dict[str, dict[str, Column]], names_to: str = "scenario") -> DataFrame:
    """Stack copies of the future rows, each with its own predictor columns."""
    cases = F.array(*[F.struct(F.lit(label).alias("_name"), *[c.cast("double").alias(k) for k, c in cols.items()])
                      for label, cols in named.items()])
    fields = list(next(iter(named.values())))
    out = future.withColumn("_case", F.explode(cases))
    return out.select(F.col("_case._name").alias(names_to), *future.columns, *[F.col(f"_case.{k}") for k in fields])


def row_number_index(df: DataFrame, keys, ts: str, bucket_unit: str = "day", name: str = "rn",
                     reverse: bool = False) -> DataFrame:
    """Dense counter over an irregular index, as the new regular index."""
    return row_numbers(df, list(keys), F.col(ts), period_number(F.col(ts), bucket_unit), name, reverse)


def difference(df: DataFrame, spec: SeriesSpec, col: str, out: str, lag: int = 1) -> DataFrame:
    lagged = lag_columns(df, spec, {"_lag": (col, lag)})
    return lagged.withColumn(out, F.col(col) - F.col("_lag")).drop("_lag")


def stretch(df: DataFrame, spec: SeriesSpec, init: int, step: int = 1, by_row: str = "rn") -> DataFrame:
    """Expanding folds: fold i holds the first ``init + (i-1)*step`` rows.

    The output is quadratic by definition; closed-form models should use
    :func:`chronoloom.plans.crossval` helpers, which never build the folds.
    """
    counted = row_numbers(df, spec.by, F.col(spec.t), F.floor(F.col(spec.t) / BLOCK), by_row)
    size = df.groupBy(*spec.by).agg(F.count("*").alias("_n"))
    out = counted.join(size, spec.by)
    folds = F.floor((F.col("_n") - init) / step) + 1
    first = F.greatest(F.lit(1), F.ceil((F.col(by_row) - init) / step) + 1)
    out = out.where((F.col("_n") >= init) & (first <= folds))
    return out.withColumn("fold", F.explode(F.sequence(first, folds))).drop("_n")


def head(df: DataFrame, keys, order: Column, bucket: Column, n: int) -> DataFrame:
    """First ``n`` rows of each series."""
    return row_numbers(df, list(keys), order, bucket, "_rn").where(F.col("_rn") <= n).drop("_rn")


def tail(df: DataFrame, keys, order: Column, bucket: Column, n: int) -> DataFrame:
    return row_numbers(df, list(keys), order, bucket, "_rn", descending=True).where(F.col("_rn") <= n).drop("_rn")


def business_calendar(history: DataFrame, keys: list[str], ts: str, unit: str, n: int, counter: str = "t_open",
                      weekdays: int = 5) -> DataFrame:
    """Next ``n`` regular periods restricted to open hours, with a counter that
    continues the history's: open = weekday and a time of day seen before."""
    clock = F.date_format(ts, "HH:mm:ss")
    seen = history.select(*keys, clock.alias("_clock")).distinct()
    last = history.groupBy(*keys).agg(F.max(period_number(F.col(ts), unit)).alias("_last"),
                                      F.max(counter).alias("_count"))
    from chronoloom.functions.calendar import period_start
    future = last.withColumn("_t", F.explode(F.sequence(F.col("_last") + 1, F.col("_last") + n)))
    future = future.withColumn(ts, period_start(F.col("_t"), unit)).withColumn("_clock", clock)
    future = future.where(F.weekday(ts) < weekdays).join(seen, [*keys, "_clock"], "left_semi")
    numbered = row_numbers(future, keys, F.col("_t"), F.floor(F.col("_t") / BLOCK), "_rn")
    return numbered.select(*keys, ts, (F.col("_count") + F.col("_rn")).cast("long").alias(counter))


