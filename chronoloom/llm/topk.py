"""Exact top-k inner products by distributed histogram selection.

Vectors become integers, so scores are integers.  Queries and candidates are
packed into blocks; every pair of a query block and a candidate block is one row
of work, dealt out over all tasks.  A pass scores everything and counts, per
query, how many scores lie in each of BINS ranges; the range that holds the k-th
score is divided again until it is one value wide.  The last pass keeps what lies
above that value, and of the ties the smallest ids.  Each task reports only the
ranges from the top down to its own k-th score: no lower one can matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from chronoloom.llm.common import written

BINS, QUERY_BLOCK, BLOCK = 256, 1_024, 2_048
#: Scores stop here.
FAR = 4 * 10**18
PACKED = "dim int, ids array<long>, vectors binary, top double"
#: Query blocks whose counts one task holds.
HELD = 16


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """(id, v, dim): floor(scale * x) of every component; rows without id, null vectors and bad components go."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(True)))
            .select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double"))).alias("v"))
            .withColumn("dim", F.size("v")))


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of up to ``size`` vectors of one dimension, about one from each task."""
    rows = rows.repartition(max(1, -(-rows.count() // size)))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def out(dim):
            ids, vs = held.pop(dim)
            m = np.array(vs, np.int64).reshape(len(ids), dim)
            top = float(np.sqrt((m.astype(np.float64) ** 2).sum(axis=1)).max()) if len(ids) else 0.0
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([m.tobytes()], pa.binary()), pa.array([top])], ["dim", "ids", "vectors", "top"])

        for part in parts:
            for i, v, dim in zip(*[part.column(c).to_pylist() for c in ("id", "v", "dim")]):
                ids, vs = held.setdefault(dim, ([], []))
                ids.append(i)
                vs.append(v)
                if len(ids) >= size:
                    yield out(dim)
        for dim in list(held):
            yield out(dim)

    return rows.mapInArrow(batches, PACKED)


def _matrix(ids: list[int], vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.array(ids, np.int64)
    return i, np.frombuffer(vectors, np.int64).reshape(len(i), -1)


def scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by float64 where every partial sum is exact in it."""
    big = (np.abs(q).max(initial=0).astype(float) if q.size else 0.0) * (np.abs(v).max(initial=0).astype(float) if v.size else 0.0) * max(q.shape[1], 1)
    if big < 2.0**53:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    exact = q.astype(object) @ v.astype(object).T if q.shape[1] else np.zeros((len(q), len(v)), object)
    return np.clip(exact, -FAR, FAR).astype(np.int64)


def _work(blocks: DataFrame, queries: DataFrame, spread: int) -> DataFrame:
    """Every candidate block with every query block of its dimension; queries are copied to ``spread`` places."""
    blocks = blocks.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(spread)).cast("int"))
    heads = queries.groupBy("dim").agg(F.collect_list("q_block").alias("heads"))
    return (blocks.join(heads, "dim").withColumn("q_block", F.explode("heads")).drop("heads").join(queries.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))),
                                           ["dim", "q_block", "salt"]))


def _histogram(parts: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    totals: dict[int, list] = {}

    def out():
        qi, count, above = totals.pop(next(iter(totals)))
        down = count[:, ::-1].cumsum(axis=1)[:, ::-1]
        keep = (count > 0) & (down - count < (k - above)[:, None])
        at, bin_ = np.nonzero(keep)
        return pa.RecordBatch.from_arrays([pa.array(qi[at]), pa.array(bin_.astype(np.int32)), pa.array(count[at, bin_])], ["query_id", "bin", "n"])

    for part in parts:
        names = ("q_block", "ids", "vectors", "q_ids", "q_vectors", "lows", "width", "span", "above")
        for block, ids, vectors, q_ids, q_vectors, lows, width, span, above in zip(*[part.column(c).to_pylist() for c in names]):
            i, v = _matrix(ids, vectors)
            qi, q = _matrix(q_ids, q_vectors)
            low, w, span = (np.array(x, np.int64)[:, None] for x in (lows, width, span))
            above_low = scores(q, v) - low
            place = above_low // w
            place[(above_low < 0) | (above_low >= span) | (qi[:, None] == i[None, :])] = BINS
            place += np.arange(len(qi))[:, None] * (BINS + 1)
            count = np.bincount(place.ravel(), minlength=len(qi) * (BINS + 1)).reshape(len(qi), BINS + 1)[:, :BINS]
            if block in totals:
                totals[block][1] += count
            else:
                totals[block] = [qi, count, np.array(above, np.int64)]
            if len(totals) > HELD:
                yield out()
    while totals:
        yield out()


def _select(parts: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    names = ("ids", "vectors", "q_ids", "q_vectors", "lows", "above")
    for part in parts:
        for ids, vectors, q_ids, q_vectors, lows, above in zip(*[part.column(c).to_pylist() for c in names]):
            i, v = _matrix(ids, vectors)
            qi, q = _matrix(q_ids, q_vectors)
            order = np.argsort(i, kind="stable")
            i, v = i[order], v[order]
            s, kth = scores(q, v), np.array(lows, np.int64)[:, None]
            s_own = qi[:, None] == i[None, :]
            tie = (s == kth) & ~s_own
            first = tie.cumsum(axis=1) <= (k - np.array(above, np.int64))[:, None]
            at, to = np.nonzero(((s > kth) & ~s_own) | (tie & first))
            yield pa.RecordBatch.from_arrays([pa.array(qi[at]), pa.array(i[to]), pa.array(s[at, to])], ["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores, ties to the smaller id.

    A query's own id is no candidate.  Vectors of another dimension are no
    candidates either.  Rows that repeat an id are one query (the smallest
    vector) and several candidates.  Empty tables and tables without queries
    give an empty result.
    """
    rows = quantised(vectors, id_col, vector_col, scale)
    blocks = written(packed(rows, BLOCK), "blocks")
    asked = rows.where(F.coalesce(is_query, F.lit(False))).groupBy("id").agg(F.min(F.struct("v", "dim")).alias("r")).select("id", "r.v", "r.dim")
    queries = written(packed(written(asked, "asked"), QUERY_BLOCK).select(
        "dim", F.monotonically_increasing_id().alias("q_block"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
        F.col("top").alias("q_top")), "queries")
    tops = blocks.groupBy("dim").agg(F.max("top").alias("top"))
    spread = max(1, -(-blocks.count() // 4))
    # scores lie within the product of the norms
    reach = F.ceil(F.least(F.col("q_top") * F.col("top") + 1, F.lit(float(FAR))))
    state = written(queries.join(tops, "dim").select(F.explode("q_ids").alias("query_id"), reach.alias("reach")).select(
        "query_id", (-F.col("reach")).alias("low"), (F.floor((2 * F.col("reach") + 1) / BINS) + 1).cast("long").alias("width"),
        (2 * F.col("reach") + 1).alias("span"), F.lit(0).cast("long").alias("above")), "state")
    while True:
        bins = _work(blocks, _with_state(queries, state), spread).mapInArrow(lambda it: _histogram(it, k), "query_id long, bin int, n long")
        bins = bins.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        seen = bins.withColumn("upto", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0)))
        hit = seen.join(state.select("query_id", "low", "width", "above"), "query_id").where(F.col("above") + F.col("upto") - F.col("n") < k)
        # the range of the k-th score, or the lowest one that holds any
        hit = hit.groupBy("query_id").agg(F.min(F.struct("bin", "upto", "n", "low", "width", "above")).alias("h"))
        finer = F.when(F.col("h.width") == 1, 1).otherwise(F.floor((F.col("h.width") - 1) / BINS) + 1)
        state = written(hit.select("query_id", (F.col("h.low") + F.col("h.bin") * F.col("h.width")).alias("low"), finer.cast("long").alias("width"),
                                   F.col("h.width").alias("span"), (F.col("h.above") + F.col("h.upto") - F.col("h.n")).alias("above"), (F.col("h.width") > 1).alias("open")), "state")
        if state.where("open").isEmpty():
            break
    found = _work(blocks, _with_state(queries, state), spread).mapInArrow(lambda it: _select(it, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _with_state(queries: DataFrame, state: DataFrame) -> DataFrame:
    """Query blocks with the current range of each of their queries, in their order."""
    each = queries.select("q_block", F.posexplode("q_ids").alias("at", "query_id")).join(state, "query_id", "left")
    none = F.lit(0).cast("long")
    row = F.struct("at", F.coalesce("low", none).alias("low"), F.coalesce("width", none + 1).alias("width"),
                   F.coalesce("span", none).alias("span"), F.coalesce("above", none).alias("above"))
    each = each.groupBy("q_block").agg(F.array_sort(F.collect_list(row)).alias("s"))
    return queries.join(each, "q_block").select("dim", "q_block", "q_ids", "q_vectors", F.col("s.low").alias("lows"),
                                                F.col("s.width").alias("width"), F.col("s.span").alias("span"), F.col("s.above").alias("above"))
