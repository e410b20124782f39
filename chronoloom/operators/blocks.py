"""Bounded time blocks: how ordered work runs without one task per series.

A ``Window.partitionBy(key)`` puts a whole series in one task.  A single series
may hold a third of all rows, so ordered operators use blocks of consecutive
periods instead:

* neighbour access (lags, moving frames): each block also receives copies of
  the few rows next to its edges, and only its own rows are kept;
* running totals: totals within the block plus the sum of the earlier blocks;
* recursions: the state at the end of a block is handed to the next block.

Nothing ever holds more than one block of one series.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronoloom.series import SeriesSpec, require_gapless

BLOCK = 65_536


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder named by the session."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="chronoloom-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def halo_frame(df: DataFrame, by: list[str], t: str, before: int, after: int,
               block: int | None = None) -> tuple[DataFrame, Window]:
    """Rows copied into every block that needs them, and the block window.

    A row in the last ``before`` periods of a block is also needed by the next
    block; one in the first ``after`` periods by the previous block.
    Filter on ``_home`` after the window expressions.
    """
    block = max(block or BLOCK, before, after, 1)
    pos = F.pmod(F.col(t), F.lit(block))
    own = F.floor(F.col(t) / block)
    # one output row per block the row is needed in: its own, and at the edges a neighbour
    low = own - F.when(pos < after, 1).otherwise(0) if after else own
    high = own + F.when(pos >= block - before, 1).otherwise(0) if before else own
    out = (df.withColumn("_own", own)
             .withColumn("_blk", F.explode(F.sequence(low, high)))
             .withColumn("_home", F.col("_own") == F.col("_blk")))
    return out, Window.partitionBy(*by, "_blk").orderBy(t)


def windowed(df: DataFrame, spec: SeriesSpec, columns: dict, before: int = 0, after: int = 0,
             by: list[str] | None = None, t: str | None = None, block: int | None = None) -> DataFrame:
    """Add window columns that look at most ``before``/``after`` rows away.

    ``columns`` maps a name to ``f(window) -> Column``.
    """
    by = spec.by if by is None else by
    out, w = halo_frame(df, by, t or spec.t, before, after, block)
    out = out.withColumns({name: f(w) for name, f in columns.items()})
    return out.where("_home").drop("_own", "_blk", "_home")


def lag_columns(df: DataFrame, spec: SeriesSpec, lags: dict[str, tuple[str, int]],
                block: int | None = None) -> DataFrame:
    """Add ``name -> (column, k)`` time lags (k > 0 looks back, k < 0 ahead)."""
    require_gapless(spec, "a time lag")
    back = max([k for _, k in lags.values()] + [0])
    ahead = max([-k for _, k in lags.values()] + [0])
    cols = {name: (lambda w, c=c, k=k: F.lag(c, k).over(w)) for name, (c, k) in lags.items()}
    return windowed(df, spec, cols, back, ahead, block=block)


def running_sums(df: DataFrame, by: list[str], t: str, sums: dict[str, Column],
                 block: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sums`` along ``t`` per key."""
    block = block or BLOCK
    blk = F.floor(F.col(t) / block)
    base = df.withColumns({f"_v_{n}": c for n, c in sums.items()}).withColumn("_blk", blk)
    totals = base.groupBy(*by, "_blk").agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in sums])
    earlier = Window.partitionBy(*by).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_blk", *[
        F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums])
    inside = Window.partitionBy(*by, "_blk").orderBy(t).rowsBetween(Window.unboundedPreceding, 0)
    out = base.withColumns({f"_r_{n}": F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)) for n in sums})
    out = out.join(offsets, [*by, "_blk"])
    out = out.withColumns({n: F.col(f"_r_{n}") + F.col(f"_o_{n}") for n in sums})
    return out.drop("_blk", *[f"{p}{n}" for n in sums for p in ("_v_", "_r_", "_o_")])


def row_numbers(df: DataFrame, by: list[str], order: Column, bucket: Column | None = None, name: str = "rn",
                descending: bool = False) -> DataFrame:
    """``row_number`` along ``order`` per key, whatever the share of a key or a stretch of time.

    Rows are range-partitioned by key and order, so a hot key spreads over as
    many tasks as its rows fill.  Only the first key of a task can have begun
    in earlier ones: what it needs to know is one row for each task.
    ``bucket`` is not needed any more and kept for callers that pass it.
    """
    del bucket
    way = order.desc() if descending else order.asc()
    keys = [F.col(c) for c in by]
    laid = cut_lineage(df.withColumn("_o", order).repartitionByRange(*keys, way).sortWithinPartitions(*keys, way))
    at = F.monotonically_increasing_id()  # task number and place, fixed by the checkpoint
    laid = laid.withColumn("_id", at).withColumn("_task", F.shiftright("_id", 33))
    counts = laid.groupBy(*by, "_task").agg(F.count(F.lit(1)).alias("_n"))
    # keys that lie in more than one task; one task holds at most one such key from before
    split = counts.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_task", "_n"))).alias("_t")).where(F.size("_t") > 1)
    split = split.select(*by, F.explode(F.transform("_t", lambda x, i: F.struct(x["_task"].alias("_task"), F.aggregate(
        F.slice("_t", F.lit(1), i), F.lit(0).cast("long"), lambda s, v: s + v["_n"]).alias("_off")))).alias("_x"))
    split = split.select(*[F.col(c).alias(f"_k_{c}") for c in by], F.col("_x._task").alias("_k_task"), F.col("_x._off").alias("_off")).where("_off > 0")
    inside = Window.partitionBy(*by, "_task").orderBy("_id")
    same = F.col("_task") == F.col("_k_task")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    out = laid.withColumn("_in", F.row_number().over(inside)).join(F.broadcast(split), same, "left")
    return out.withColumn(name, (F.col("_in") + F.coalesce("_off", F.lit(0))).cast("long")).select(*[c for c in df.columns if c != name], name)


def block_arrays(df: DataFrame, by: list[str], t: str, cols: list[str], block: int | None = None,
                 name: str = "pts") -> DataFrame:
    """One row per (key, block) with its points as an array in time order."""
    block = block or BLOCK
    return (df.groupBy(*by, F.floor(F.col(t) / block).alias("blk"))
              .agg(F.array_sort(F.collect_list(F.struct(t, *cols))).alias(name)))


def block_scan(df: DataFrame, start: DataFrame, by: list[str], t: str, cols: list[str], step,
               block: int | None = None, emit=None) -> DataFrame:
    """Run a recursion along each series, block after block.

    ``start`` has one row per key (or per key and candidate) with a column
    ``state``.  ``step(state, point)`` returns the next state; points are
    structs of ``t`` and ``cols``.  Returns ``start`` with the final state.
    Series that fit one block take one pass; longer ones take one pass per
    block, so no task ever holds more than a block of points.

    With ``emit`` (name of a state field holding an array of outputs) the
    outputs are returned instead: one row per key and block.
    """
    arrays = block_arrays(df, by, t, cols, block)
    span = arrays.agg(F.min("blk"), F.max("blk")).first()
    if span[0] is None:
        return start
    if span[0] == span[1]:
        joined = start.join(arrays.drop("blk"), by, "left")
        done = joined.withColumn("state", F.when(F.col("pts").isNull(), F.col("state"))
                                 .otherwise(F.aggregate("pts", F.col("state"), step)))
        return done.drop("pts")
    arrays = arrays.persist()
    state, outputs = start, None
    for b in range(span[0], span[1] + 1):
        joined = state.join(arrays.where(F.col("blk") == b).drop("blk"), by, "left")
        state = joined.withColumn("state", F.when(F.col("pts").isNull(), F.col("state"))
                                  .otherwise(F.aggregate("pts", F.col("state"), step))).drop("pts")
        if emit:
            piece = cut_lineage(state)
            outputs = piece if outputs is None else outputs.unionByName(piece)
            state = piece.withColumn("state", F.col("state").withField(
                emit, F.slice(F.col(f"state.{emit}"), 1, 0)))
        elif (b - span[0]) % 8 == 7:
            state = cut_lineage(state)
    return outputs if emit else state
